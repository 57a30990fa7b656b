"""Byte-level BPE with a segment tree over byte positions, and its decoding."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import int_lists, map_batches, worker_memory

NEVER = 1 << 62
#: Remembered units of a worker process; the memory is started anew beyond that.
REMEMBERED = 300_000
#: White space of the Unicode standard, which the split pattern means by its space class.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class MergeTree:
    """Merges the bytes of one piece by rank.

    Leaf i belongs to the part that begins at byte i and holds the rank of joining it
    with the part after it; an inner node holds the smallest rank below it and, among
    equal ranks, the leftmost byte position. A merge changes three leaves: its own, the
    absorbed neighbour's and the left neighbour's.
    """

    def __init__(self, piece: bytes, ranks: dict[bytes, int], longest: int) -> None:
        n = len(piece)
        self.piece, self.ranks, self.longest = piece, ranks, longest
        self.after = list(range(1, n + 2))
        self.before = list(range(-1, n))
        self.width = 1 << max(n - 1, 1).bit_length()
        self.tree = [NEVER] * (2 * self.width)
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                self.tree[self.width + i] = rank << 32 | i
        for node in range(self.width - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])

    def put(self, position: int, value: int) -> None:
        tree, node = self.tree, self.width + position
        tree[node] = value
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left < right else right
            if tree[node] == low:
                break
            tree[node] = low

    def pair(self, position: int) -> int:
        """What the leaf at a part's first byte has to hold."""
        middle = self.after[position]
        if middle >= len(self.piece):
            return NEVER
        end = self.after[middle]
        if end - position > self.longest:
            return NEVER
        rank = self.ranks.get(self.piece[position:end])
        return NEVER if rank is None else rank << 32 | position

    def merged(self) -> list[bytes]:
        while self.tree[1] < NEVER:
            at = self.tree[1] & 0xFFFFFFFF
            gone = self.after[at]
            end = self.after[gone]
            self.after[at] = end
            if end < len(self.piece):
                self.before[end] = at
            self.put(gone, NEVER)
            self.put(at, self.pair(at))
            if self.before[at] >= 0:
                self.put(self.before[at], self.pair(self.before[at]))
        parts, at = [], 0
        while at < len(self.piece):
            parts.append(self.piece[at : self.after[at]])
            at = self.after[at]
        return parts


class ByteBPE:
    """Encodes texts as the ranks and the split pattern say, without special tokens.

    A unit is a run of white space with the characters up to the next white space. No
    match of the pattern reaches over the end of a unit, and none depends on an earlier
    one, so units are encoded on their own and their ids are remembered.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import re

        import regex

        exact = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
        self.split = regex.compile(exact).findall
        self.units = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.known: dict[str, bytes] = {}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        joins = sorted(
            (ranks[token[:at]] << 32 | ranks[token[at:]], rank)
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if token[:at] in ranks and token[at:] in ranks
        )
        self.pairs, self.joined = np.array(joins, np.int64).reshape(-1, 2).T.copy()

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens join to, NEVER if there is none."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.joined[at], NEVER >> 16)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Merges many short pieces side by side: one row of each array is the `MergeTree`
        of one piece, and a step does the next merge of every piece that has one."""
        n, lengths = len(pieces), np.array([len(p) for p in pieces])
        width = 1 << int(lengths.max() - 1).bit_length()
        ids = self.of_byte[np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(n, width)]
        places = np.arange(width)
        alive = places < lengths[:, None]
        after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        tree = np.full((n, 2 * width), NEVER, np.int64)
        ranks = np.where(alive[:, 1:], self.pair_ranks(ids[:, :-1], ids[:, 1:]), NEVER >> 16)
        tree[:, width : 2 * width - 1] = ranks << 16 | places[:-1]
        low = width
        while low > 1:
            low >>= 1
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])

        def put(rows: np.ndarray, position: np.ndarray, value: np.ndarray | int) -> None:
            node = position + width
            tree[rows, node] = value
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def refresh(rows: np.ndarray, position: np.ndarray) -> None:
            following = after[rows, position]
            inside = following < lengths[rows]
            rank = self.pair_ranks(ids[rows, position], ids[rows, np.where(inside, following, 0)])
            put(rows, position, np.where(inside, rank, NEVER >> 16) << 16 | position)

        rows = np.arange(n)
        while True:
            least = tree[rows, 1]
            rows = rows[least < NEVER]
            if not len(rows):
                break
            least = least[least < NEVER]
            at = least & 0xFFFF
            gone = after[rows, at]
            end = after[rows, gone]
            ids[rows, at] = least >> 16
            alive[rows, gone] = False
            after[rows, at] = end
            before[rows, end] = at
            put(rows, gone, NEVER)
            refresh(rows, at)
            earlier = before[rows, at]
            refresh(rows[earlier >= 0], earlier[earlier >= 0])
        packed = ids[alive].astype("<i4").tobytes()
        ends = (4 * np.cumsum(alive.sum(1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct pieces, as 32-bit integers one after the other."""
        found: dict[bytes, bytes] = {}
        short: dict[int, list[bytes]] = {}
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:
                found[piece] = whole.to_bytes(4, "little")
            elif len(piece) <= 64:
                short.setdefault((len(piece) - 1).bit_length(), []).append(piece)
            else:
                parts = MergeTree(piece, self.ranks, self.longest).merged()
                found[piece] = array("i", [self.ranks[p] for p in parts]).tobytes()
        for same in short.values():
            for begin in range(0, len(same), 8192):
                block = same[begin : begin + 8192]
                found |= zip(block, self.merge_many(block))
        return found

    def learn(self, units: list[str]) -> None:
        if len(self.known) + len(units) > REMEMBERED:
            self.known.clear()
        parts = [[m.encode("utf-8") for m in self.split(u)] for u in units]
        found = self.encode_pieces(list(dict.fromkeys([p for x in parts for p in x])))
        for unit, pieces in zip(units, parts):
            self.known[unit] = found[pieces[0]] if len(pieces) == 1 else b"".join([found[p] for p in pieces])

    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as 32-bit integers; the new units of about a million
        characters are encoded together."""
        begin = 0
        while begin < len(texts):
            split, chars = [], 0
            while begin + len(split) < len(texts) and chars < 1_000_000:
                text = texts[begin + len(split)] or ""
                chars += len(text)
                split.append(self.units(text))
            distinct = dict.fromkeys(u for x in split for u in x)
            if len(self.known) + len(distinct) > REMEMBERED:
                self.known.clear()
            known = self.known
            self.learn([u for u in distinct if u not in known])
            for units in split:
                yield b"".join([known[u] for u in units])
            begin += len(split)

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))


def _encoder(path: str, pattern: str) -> ByteBPE:
    """One encoder for each worker process, as Python workers serve many tasks."""
    return worker_memory(("byte_bpe", path, pattern), lambda: ByteBPE(read_ranks(path), pattern))


class Decoder:
    """The bytes of each id of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids.tolist()])


def bpe_encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """(id, ids array<int>) of every whole text, one row per input row.

    `vocabulary` is the path of a rank file that every executor has. A NULL text is an
    empty one and gives an empty array; repeated and NULL ids stay as they are; other
    columns, whatever their names, are not read. Work is per row: no shuffle, and a text
    is held by one task only. With `decoded`, the ids are decoded again in the same task
    and the bytes come along as a column of that name.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    schema = f"key {dict(rows.dtypes)['key']}, ids array<int>" + ", decoded binary" * decoded

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = _encoder(vocabulary, pattern)
        decoder = Decoder(encoder.ranks) if decoded else None
        for b in batches:
            packed = list(encoder.encode_many(b["body"]))
            out = {"key": b["key"], "ids": int_lists(packed)}
            if decoder:
                out["decoded"] = [decoder.decode(np.frombuffer(p, "<i4")) for p in packed]
            yield out

    return map_batches(rows, work, schema).withColumnRenamed("key", id_col)


def bpe_decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded binary): the bytes that the ids stand for; NULL ids give empty bytes.

    An id that the vocabulary lacks raises.
    """
    rows = encoded.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    kind = dict(rows.dtypes)["key"]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        decoder = Decoder(read_ranks(vocabulary))
        for b in batches:
            yield b | {"decoded": [decoder.decode(np.array(ids or [], np.int64)) for ids in b["ids"]]}

    return map_batches(rows, work, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", id_col)
