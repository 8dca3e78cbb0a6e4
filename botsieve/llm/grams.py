"""Byte n-gram presence vectors over a fixed number of hashed places."""

import numpy as np

PIECE = 1 << 20   # bytes of a text that are hashed at once (bounded memory)
MIX = np.uint64(0x9E3779B97F4A7C15)


class Presence:
    """Presence vectors of n-grams of some orders, ``2**bits`` places.

    ``ids`` gives the places one text has, ``matrix`` the 0/1 rows of a batch.
    Long texts are read in pieces that overlap by the longest order.
    """

    def __init__(self, orders: tuple[int, ...], bits: int):
        self.orders, self.bits = orders, bits
        self.flags = np.zeros(1 << bits, bool)

    def mark(self, data: bytes, flags: np.ndarray) -> None:
        reach = max(self.orders) - 1
        for at in range(0, len(data), PIECE):
            part = np.frombuffer(data, np.uint8, min(PIECE + reach, len(data) - at), at).astype(np.uint64)
            code, shift = np.zeros(len(part), np.uint64), np.uint64(64 - self.bits)
            for n in range(1, reach + 2):
                if len(part) < n:
                    break
                # The n bytes from each place on, as one number (n up to 7).
                code = code[:len(part) - n + 1] << np.uint64(8) | part[n - 1:]
                if n in self.orders:
                    flags[((code + np.uint64(n << 56)) * MIX) >> shift] = True

    def ids(self, data: bytes) -> np.ndarray:
        self.mark(data, self.flags)
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found

    def matrix(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), 1 << self.bits), bool)
        for row, data in zip(out, texts):
            self.mark(data, row)
        return out
