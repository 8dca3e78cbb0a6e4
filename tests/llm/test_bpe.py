import hashlib
import random
import tracemalloc

import public_tokenizers
import pyarrow.parquet as pq
from conftest import SF0001
from llm_cases import edge_docs, edge_rows, no_docs, save
from tokenizers import Tokenizer

from botsieve.llm import bpe

PATH = public_tokenizers.path(bpe.VOCAB)


def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def wanted(text, lib):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    data = b"".join(i.to_bytes(4, "little") for i in ids)
    decoded = lib.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_encoder_against_the_library():
    lib, enc = library(), bpe.Encoder(open(PATH, encoding="utf-8").read())
    rnd = random.Random(1)
    pool = [chr(c) for c in [*range(0x250), *range(0x370, 0x500), 0x1c, 0x85, 0x2028, 0x3000, 0x200b, 0x1f600, 0x301,
                             0xac00, 0x1161, 0xfb01, 0x212b, 0x130, 0x3a3]]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|> Hi <|startoftext|>x<|endoftext|>", "<|startoftext", "don't it's WE'LL 4½ ΑΣ İ", "x" * 3000,
              "ab" * 400 + "!" * 300, "日本語 🤖👩‍👩‍👧"]
    for text in texts:
        ids = enc.encode(text)
        want = lib.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == want
        assert enc.decode(want) == lib.decode(want, skip_special_tokens=False)


def test_long_words_merge_alike():
    """The heap of long words gives what the scan of short words gives."""
    enc = bpe.Encoder(open(PATH, encoding="utf-8").read())
    rnd = random.Random(2)
    for _ in range(200):
        word = "".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, bpe.LONG_WORD))).encode()
        parts = [enc.inner[b] for b in word]
        parts[-1] = enc.last[word[-1]]
        assert enc.merge_long(parts) == enc.merge(word)


def test_long_texts_in_runs(monkeypatch):
    enc = bpe.Encoder(open(PATH, encoding="utf-8").read())
    text = "".join(random.Random(3).choice(["ab", " ", "\n ", "c-d", "\x1c", "é"]) for _ in range(3000))
    whole = enc.encode(text)
    monkeypatch.setattr(bpe, "RUN", 7)
    assert enc.encode(text) == whole and enc.encode(text + "  ") == whole and enc.encode(" ") == b""


def test_cache_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 4000)
    enc = bpe.Encoder(open(PATH, encoding="utf-8").read())
    plain = bpe.Encoder(open(PATH, encoding="utf-8").read())
    text = " ".join(f"word{i}" for i in range(100))
    assert enc.encode(text) == plain.encode(text) and enc.held <= 4000 and len(enc) < 20


def test_unspaced_scripts_do_not_fill_the_cache():
    """Passages without spaces, each of another text: their words are kept, not the passages."""
    enc = bpe.Encoder(open(PATH, encoding="utf-8").read())
    rnd = random.Random(4)
    tracemalloc.start()
    for _ in range(3000):
        chunk = "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(rnd.choice([20, 300]))) + "。"
        enc.encode(chunk * 2)
    assert enc.held <= bpe.CACHE_BYTES and tracemalloc.get_traced_memory()[0] < 1.3 * enc.held + 1e6
    tracemalloc.stop()
    assert max(map(len, enc)) <= bpe.CACHED_CHUNK


def test_query_and_edge_cases(spark, tmp_path):
    lib = library()
    rows = bpe.op9(spark, save(tmp_path, documents=edge_docs(spark))).collect()
    want = sorted((str(r[0]), *wanted(r[1], lib)) for r in edge_rows())
    assert sorted((str(r[0]), *r[1:]) for r in rows) == want
    assert bpe.op9(spark, save(tmp_path / "none", documents=no_docs(spark))).count() == 0


def test_query_on_the_table(spark):
    lib = library()
    texts = dict(zip(*pq.read_table(f"{SF0001}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    for r in bpe.op9(spark, SF0001).collect():
        assert tuple(r)[1:] == wanted(texts[r.doc_id], lib)


def test_ids_column(spark):
    docs = bpe.encode(edge_docs(spark), bpe.vocabulary(spark))
    assert docs.columns == ["doc_id", "ids", "decoded"]
    got = {r.doc_id: r for r in docs.collect()}
    assert got[9].ids == library().encode("one", add_special_tokens=False).ids and got[3].ids == []
