"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut in halves down to leaves; a leaf is encoded as it stands. Two neighbours are
joined by encoding a window around their boundary again and growing it until the tokens
outside cannot change:

* Between pieces of the split pattern: a blank after a non-blank begins a piece whatever
  stands around it, and the piece before it ends there. The window grows to the nearest
  such place on either side (or the end of the text); tokens beyond stay as they are.
* Inside one long piece: a token sequence is the encoding of its bytes if every two
  neighbouring tokens, encoded together, give themselves. The merge that would be the first
  to cross a boundary would also cross it in the encoding of those two alone. The window
  grows until both its outer pairs pass.

Decoding joins bytes up the tree.

Defined results: a null or empty text gives no ids; repeated rows are encoded each by
itself; columns other than id and text are left out. An empty table gives an empty table.
"""
from __future__ import annotations

import base64
import functools
import unicodedata
from array import array
from collections.abc import Callable

import regex
import tiktoken
from pyspark.sql import DataFrame

from lakeproof.llm.common import by_rows, texts

LEAF = 2048          # code points encoded at once
LONG_WINDOW = 4096   # from here on a window is joined piece by piece
LEAF_PIECE = 256     # bytes of one piece merged at once
# White space as Unicode defines it, without the separators \x1c-\x1f.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
FIRM = regex.compile(rf"[^{BLANK}][\t-\r ]")
# Characters on whose class two Unicode versions or regex libraries may not agree.
UNSURE = regex.compile(r"[\x1c-\x1f]")

ENCODED = "doc_id long, ids binary"
ROUND_TRIP = "doc_id long, ids binary, decoded binary"


class TreeCodec:
    """Encodes and decodes with one rank file (its content) and one split pattern."""

    def __init__(self, rank_file: bytes, pattern: str, leaf: int = LEAF,
                 long_window: int = LONG_WINDOW, leaf_piece: int = LEAF_PIECE):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.flat = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks,
                                      special_tokens={})
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks), default=0)
        self.pattern = regex.compile(pattern)
        self.leaf, self.long_window, self.leaf_piece = leaf, long_window, leaf_piece
        self.pairs: dict[tuple[int, int], bool] = {}

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self.flat.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        left, right = self._encode(text, lo, mid), self._encode(text, mid, hi)
        return self._join(text, lo, mid, hi, left, right)

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int],
              right: list[int]) -> list[int]:
        start, end = self._firm_before(text, lo, mid), self._firm_after(text, mid, hi)
        keep = len(left) - self._tokens_over(reversed(left), len(text[start:mid].encode()))
        drop = self._tokens_over(right, len(text[mid:end].encode()))
        if end - start <= self.long_window:
            window = self.flat.encode_ordinary(text[start:end])
        else:
            window = self._join_pieces(text, start, mid, end, left[keep:], right[:drop])
        return left[:keep] + window + right[drop:]

    def _tokens_over(self, tokens, n_bytes: int) -> int:
        """How many tokens make up the next ``n_bytes``; they end exactly there."""
        count = 0
        for t in tokens:
            if n_bytes <= 0:
                break
            n_bytes -= len(self.token[t])
            count += 1
        return count

    @staticmethod
    def _firm_before(text: str, lo: int, mid: int) -> int:
        width = 32
        while True:
            at = max(lo, mid - width)
            last = -1
            for m in FIRM.finditer(text, at, mid):
                last = m.start() + 1
            if last > 0:
                return last
            if at == lo:
                return lo
            width *= 4

    @staticmethod
    def _firm_after(text: str, mid: int, hi: int) -> int:
        found = FIRM.search(text, mid, hi)
        return found.start() + 1 if found else hi

    # -- long windows: pieces that stayed keep their tokens, at most one crosses the boundary

    def _join_pieces(self, text: str, start: int, mid: int, end: int, left: list[int],
                     right: list[int]) -> list[int]:
        window = text[start:end]
        if UNSURE.search(window) or any(unicodedata.category(c) == "Cn" for c in set(window)):
            return self.flat.encode_ordinary(window)
        known = self._by_piece(text, start, mid, left) | self._by_piece(text, mid, end, right)
        out: list[int] = []
        for m in self.pattern.finditer(window):
            a, b = m.start() + start, m.end() + start
            if (a, b) in known:
                out += known[a, b]
            elif (a, mid) in known and (mid, b) in known:
                out += self.join_tokens(known[a, mid], known[mid, b])
            else:
                out += self.encode_piece(m.group().encode())
        return out

    def _by_piece(self, text: str, start: int, end: int, tokens: list[int]) -> dict:
        found, at = {}, 0
        for m in self.pattern.finditer(text[start:end]):
            n = self._tokens_over(tokens[at:at + len(m.group()) * 4], len(m.group().encode()))
            found[m.start() + start, m.end() + start] = tokens[at:at + n]
            at += n
        return found

    # -- one piece

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; a piece that is itself a token is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(piece) <= self.leaf_piece:
            return self.merge(piece)
        mid = len(piece) // 2
        return self.join_tokens(self.encode_piece(piece[:mid]), self.encode_piece(piece[mid:]))

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.merge(b"".join(self.token[t] for t in left[a:] + right[:b]))
            if (a == 0 or self._stable(left[a - 1], window[0])) and \
                    (b == len(right) or self._stable(window[-1], right[b])):
                if a == 0 and b == len(right):
                    whole = b"".join(self.token[t] for t in window)
                    window = [self.ranks[whole]] if whole in self.ranks else window
                return left[:a] + window + right[b:]
            width *= 2

    def _stable(self, a: int, b: int) -> bool:
        if (a, b) not in self.pairs:
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            self.pairs[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return self.pairs[a, b]

    def merge(self, piece: bytes) -> list[int]:
        """Plain BPE: again and again the leftmost pair of the lowest rank becomes one."""
        if len(piece) > self.longest:   # no token itself, so the library merges it plainly too
            return self.flat._encode_single_piece(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = len(self.ranks) + 1
        rank = [self.ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while rank and (low := min(rank)) < none:
            i = rank.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del rank[i]
            for j in (i - 1, i):
                if 0 <= j < len(rank):
                    rank[j] = self.ranks.get(parts[j] + parts[j + 1], none)
        return [self.ranks[p] for p in parts]

    def decode(self, ids: list[int] | array) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.token.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@functools.lru_cache(maxsize=2)
def codec_of(rank_file: bytes, pattern: str) -> TreeCodec:
    """One codec for all tasks of a Python worker."""
    return TreeCodec(rank_file, pattern)


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if array("I", [1]).tobytes()[0] != 1:
        packed.byteswap()
    return packed.tobytes()


def unpack_ids(data: bytes) -> array:
    ids = array("I")
    ids.frombytes(data)
    if array("I", [1]).tobytes()[0] != 1:
        ids.byteswap()
    return ids


def encode(df: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each whole text, packed as by ``pack_ids``."""
    def start() -> Callable[[int, str], tuple]:
        codec = codec_of(rank_file, pattern)
        return lambda doc, text: (doc, pack_ids(codec.encode(text or "")))
    return by_rows(texts(df, id_col, text_col), ENCODED, start)


def decode(df: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded`` from what ``encode`` gives."""
    def start() -> Callable[[int, bytes], tuple]:
        codec = codec_of(rank_file, pattern)
        return lambda doc, ids: (doc, ids, codec.decode(unpack_ids(ids or b"")))
    return by_rows(df.select("doc_id", "ids"), ROUND_TRIP, start)
