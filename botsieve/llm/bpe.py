"""BPE encoding and decoding with word-end merges over contiguous rank arrays.

A word is held as two short lists: the ids of its parts, and beside each part
the rank of its pair with the next part. The list of ranks is scanned for its
minimum, the pair there is merged (one boundary goes), and the two
neighbouring ranks are looked up again. Words are short, so a scan of a few
contiguous numbers is cheaper than a heap. A word above ``LONG_WORD`` parts
uses a heap over the same ranks instead, because repeated scans would take
quadratic time; both give the same merges (lowest rank first, then leftmost).

The vocabulary file is read on the driver and broadcast (a fixed file of about
2 MB); executors do not open it. Text handling follows the file: text is cut
at the special tokens, each piece is NFC-normalised, white space is folded,
letters are lower-cased, and the words of the split pattern become byte
symbols with a word-end mark on the last.

Defined results: null or empty text has no ids and decodes to the empty text;
equal texts get equal results; a long text is encoded in runs that end at white
space; an empty table has no rows; nothing depends on other columns.
"""

import hashlib
import heapq
import json
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_udf, struct_array, table, utf8

VOCAB = "word_bpe_49k.json"
LONG_WORD = 64          # parts; longer words are merged with a heap
RUN = 1 << 18           # characters that are split into words at once
CACHE_BYTES = 64 << 20  # per task, keys and ids as Python holds them; the cache is emptied when full
CACHED_CHUNK = 64       # characters; a longer chunk hardly comes again and is not kept
ENTRY = 104             # bytes of a dictionary's entry, at most
NONE = 1 << 60          # in place of a rank, for a pair that does not merge
ID_BITS = 20            # a merge is held as one number: rank, then the new id

# Fixed values of the vocabulary file's format: the split pattern (white space
# as the Unicode property), and the printable characters that stand for bytes.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the
    next free one from U+0100 on."""
    symbols, free = [], 0x100
    for b in range(256):
        if b in PRINTABLE:
            symbols.append(chr(b))
        else:
            symbols.append(chr(free))
            free += 1
    return symbols


class Encoder(dict):
    """Chunks of text without white space -> ids as little-endian bytes.

    The mapping is the cache itself: ``self[chunk]`` computes what is missing.
    A chunk of several words is put together from the words' entries. Scripts
    without spaces give chunks as long as passages: only their words are kept.
    """

    def __init__(self, spec: str):
        super().__init__()
        self.held = 0           # bytes in the cache
        spec = json.loads(spec)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        # Merges by left id, then right id; ids without merges share one dict.
        nothing = {}
        self.right = [nothing] * (max(vocab.values()) + 1)
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if self.right[vocab[a]] is nothing:
                self.right[vocab[a]] = {}
            self.right[vocab[a]][vocab[b]] = rank << ID_BITS | vocab[a + b]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        named = vocab | self.special
        self.tokens = [""] * (max(named.values()) + 1)
        for token, i in named.items():
            self.tokens[i] = token
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        self.gaps = regex.compile(f"[{WHITE}]+")

    def __missing__(self, chunk: str) -> bytes:
        words = [chunk] if chunk.isalpha() else self.words.findall(chunk)
        if words == [chunk]:
            ids = array("I", self.merge(chunk.encode("utf-8", "surrogatepass"))).tobytes()
        else:
            ids = b"".join([self[word] for word in words])
        if len(chunk) <= CACHED_CHUNK:
            self.held += sys.getsizeof(chunk) + sys.getsizeof(ids) + ENTRY
            if self.held > CACHE_BYTES:
                self.clear()
                self.held = 0
            self[chunk] = ids
        return ids

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        inner, right = self.inner, self.right
        parts = [inner[b] for b in word]
        parts[-1] = self.last[word[-1]]
        if len(parts) > LONG_WORD:
            return self.merge_long(parts)
        near = [right[a].get(b, NONE) for a, b in zip(parts, parts[1:])]
        while near and (best := min(near)) != NONE:
            i = near.index(best)
            new = parts[i] = best & ((1 << ID_BITS) - 1)
            del parts[i + 1], near[i]
            if i:
                near[i - 1] = right[parts[i - 1]].get(new, NONE)
            if i < len(near):
                near[i] = right[new].get(parts[i + 1], NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges for a long word, by a heap of (merge, place)."""
        size, right = len(parts), self.right
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(m, i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (m := right[a].get(b)) is not None]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if j >= size or parts[i] is None or right[parts[i]].get(parts[j]) != best:
                continue  # one of the two has merged with another part
            parts[i], parts[j] = best & ((1 << ID_BITS) - 1), None
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size and (m := right[parts[a]].get(parts[b])) is not None:
                    heapq.heappush(heap, (m, a))
        return [p for p in parts if p is not None]

    def pieces(self, text: str):
        """(special token's id, None) and (None, ordinary text) in order."""
        if self.cut is None or not any(t in text for t in self.special):
            yield None, text
            return
        for piece in self.cut.split(text):
            if piece in self.special:
                yield self.special[piece], None
            elif piece:
                yield None, piece

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        out = []
        for special, piece in self.pieces(text):
            if piece is None:
                out.append(array("I", [special]).tobytes())
                continue
            if not unicodedata.is_normalized("NFC", piece):
                piece = unicodedata.normalize("NFC", piece)
            # Letter by letter: no final form of sigma.
            piece = piece.replace("Σ", "σ").lower()
            at = 0
            while at < len(piece):     # in runs that end at white space
                gap = self.gaps.search(piece, at + RUN) if at + RUN < len(piece) else None
                run = piece[at:gap.start() if gap else len(piece)]
                at += max(len(run), 1)
                # Python's own split also cuts at four control characters.
                odd = any(c in run for c in "\x1c\x1d\x1e\x1f")
                out.append(b"".join(map(self.__getitem__, [c for c in self.gaps.split(run) if c] if odd else run.split())))
        return b"".join(out)

    def decode(self, ids) -> str:
        """The tokens' strings joined by spaces; the file names no decoder, so
        this is what the vocabulary's own library returns."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def vocabulary(spark: SparkSession, path: str | None = None):
    """Broadcast of the vocabulary file's text (read by the driver)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCAB)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_column(spec, text: str | Column) -> Column:
    """Column of struct(ids array<int>, decoded string) for a text column."""
    kinds = [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]

    def make():
        encoder = Encoder(spec.value)

        def run(texts):
            rows = [encoder.encode((t.as_py() or b"").decode("utf-8", "replace")) for t in texts]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in rows)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(rows), "<i4"))
            return struct_array(kinds, [ids, [encoder.decode(memoryview(ids).cast("I")) for ids in rows]])
        return run
    return batch_udf(make, "ids array<int>, decoded string")(utf8(text))


def digest_column(spec, text: str | Column) -> Column:
    """Column of struct(n_tokens, ids_sha256, decoded_sha256)."""
    kinds = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def make():
        encoder = Encoder(spec.value)

        def run(texts):
            n, ids_sha, text_sha = [], [], []
            for t in texts:
                ids = encoder.encode((t.as_py() or b"").decode("utf-8", "replace"))
                decoded = encoder.decode(memoryview(ids).cast("I"))
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            return struct_array(kinds, [n, ids_sha, text_sha])
        return run
    return batch_udf(make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")(utf8(text))


def encode(docs: DataFrame, spec, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) for every row."""
    return docs.select(F.col(id_col), encode_column(spec, text).alias("e")).select(id_col, "e.ids", "e.decoded")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = docs.select("doc_id", digest_column(vocabulary(spark), "text").alias("d"))
    return out.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
