"""Alignment of two tokenizers by coalescing the byte intervals of their tokens."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwell.llm.common import many_objects, map_batches, settle, worker_memory

#: Characters of documents whose id pairs are counted together, and bytes of remembered units.
CHUNK, REMEMBERED = 8 << 20, 48 << 20
#: Characters of new units that are encoded in one call, and of documents whose pairs are sorted together.
LEARNT, SORTED = 1 << 18, 1 << 19
#: Links of a group beyond which its equal tokens are taken together first.
LARGE = 4096
#: B ids are below this; an id pair is a * B_IDS + b.
B_IDS = 1 << 15


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of each A token and of each B token.

    Both lists of tokens cover the same bytes without gaps and are given by their ends. All
    tokens are sorted by where they start; a group ends where a token starts at the largest
    end so far.
    """
    ends = np.concatenate((a_ends, b_ends))
    starts = np.concatenate(([0], a_ends[:-1], [0], b_ends[:-1])) if len(ends) else ends
    of_b = np.arange(len(ends)) >= len(a_ends)
    by = np.lexsort((of_b, starts))
    furthest = np.maximum.accumulate(ends[by])
    new = np.concatenate(([False], starts[by][1:] >= furthest[:-1]))
    group = np.empty(len(ends), np.int64)
    group[by] = np.cumsum(new)
    return group[: len(a_ends)], group[len(a_ends) :]


def linked_pairs(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id pair, how many links, group) of the links in every group; a group with many links
    gives each distinct pair once."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    large = np.flatnonzero(n_a * n_b > LARGE)
    times = np.where(np.isin(a_group, large), 0, n_b[a_group])
    first_b = (np.cumsum(n_b) - n_b)[a_group]
    owner = np.repeat(np.arange(len(a)), times)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    pair = a[owner] * B_IDS + b[first_b[owner] + inner]
    out = [(pair, np.ones(len(pair), np.int64), a_group[owner])]
    for g in large:
        a_ids, a_times = np.unique(a[a_group == g], return_counts=True)
        b_ids, b_times = np.unique(b[b_group == g], return_counts=True)
        pair = (a_ids[:, None] * B_IDS + b_ids).ravel()
        out.append((pair, np.outer(a_times, b_times).ravel(), np.full(len(pair), g)))
    return tuple(np.concatenate(x) for x in zip(*out))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 to 2^32 - 1, their lowest bytes first, then the next ones, compressed."""
    from zstandard import ZstdCompressor

    return ZstdCompressor(level=3).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    from zstandard import ZstdDecompressor

    planes = np.frombuffer(ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Numbers:
    """A numpy array that grows."""

    def __init__(self, kind: type) -> None:
        self.held, self.n = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.held):
            self.held = np.concatenate((self.held[: self.n], np.empty(max(need, 2 * self.n) - self.n, self.held.dtype)))
        self.held[self.n : need] = values
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.n]


@dataclass
class Units:
    """What is known of units: a unit is a space and what follows up to the next place where
    a text may be cut for both tokenizers. Its tokens, and so its groups, are its own."""

    number: dict[str, int] = field(default_factory=dict)
    counts: Numbers = field(default_factory=lambda: Numbers(np.int64))  # n_a, n_b, n_groups, n_links, sound
    groups: list[bytes] = field(default_factory=list)
    pairs: Numbers = field(default_factory=lambda: Numbers(np.int32))
    times: Numbers = field(default_factory=lambda: Numbers(np.int32))
    ends: Numbers = field(default_factory=lambda: Numbers(np.int64))
    size: int = 0


def regular(part: str) -> bool:
    return bool(part) and not part[0].isspace() and not part[-1].isspace()


class Aligner:
    """Encodes units with both tokenizers and groups their tokens.

    A text is cut before a space that stands between two characters that are no white
    space. A's split pattern takes such a space together with what follows, and no piece of
    B holds a space behind another character, so no token reaches over a cut and none
    depends on what is before it.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n_b = self.b.get_piece_size()
        if n_b > B_IDS:
            raise ValueError(f"{n_b} ids are more than {B_IDS}")
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces that hold a space behind other characters cannot be cut there")
        # the bytes that the letters of a byte-level vocabulary stand for
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        n_a = self.a.get_vocab_size()
        tokens = [self.a.id_to_token(i) or "" for i in range(n_a)]
        self.a_bytes = [bytes(map(byte.__getitem__, t)) if all(c in byte for c in t) else t.encode() for t in tokens]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # an id with the mark after it: A's with , and |, B's with , and ;
        self.written = [b"%d%s" % (i, mark) for n, mark in ((n_a, b","), (n_a, b"|"), (n_b, b","), (n_b, b";")) for i in range(n)]
        self.a_last, self.b_first, self.b_last = n_a, 2 * n_a, n_b
        self.units = Units()

    def keys(self, text: str) -> list[str]:
        """The units of a text: without their first space where that is the only one and no
        white space is at an end, else with it."""
        parts, known = text.split(" "), self.units.number
        if all(map(regular, set(parts).difference(known))):
            return parts
        out, run = [], parts[:1]
        for before, part in zip(parts, parts[1:]):
            if before and part and not before[-1].isspace() and not part[0].isspace():
                out.append(run)
                run = [part]
            else:
                run.append(part)
        return [r[0] if len(r) == 1 and regular(r[0]) else " " + " ".join(r) for r in [*out, run]]

    def learn(self, keys: list[str]) -> None:
        """Encode new units: the regular ones many at a time, the others each by itself."""
        block, chars = [], 0
        for key in keys:
            if key.startswith(" ") or not regular(key) or "▁" in key or len(key) > LEARNT:
                self._add([key], key if key.startswith(" ") else f" {key}")
                continue
            block.append(key)
            chars += len(key)
            if chars > LEARNT:
                self._add(block, " " + " ".join(block))
                block, chars = [], 0
        if block:
            self._add(block, " " + " ".join(block))

    def _add(self, keys: list[str], text: str) -> None:
        """Add the units of `text`, the text of all of them in a row."""
        units, raw = self.units, text.encode()
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text[1:], num_threads=1), np.int64)
        sound = b"".join([self.a_bytes[i] for i in a.tolist()]) == raw == b"".join([self.b_bytes[i] for i in b.tolist()])
        if not sound and len(keys) > 1:
            for key in keys:
                self._add([key], f" {key}")
            return
        for key in keys:
            units.number[key] = len(units.number)
        if not sound:
            units.counts.add(np.zeros(5, np.int64))
            units.groups.append(b"")
            units.ends.add(np.array([units.pairs.n]))
            return
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_group, b_group = coalesce(a_ends, b_ends)
        unit_ends = np.cumsum([len(raw)] if len(keys) == 1 else [1 + len(k.encode()) for k in keys])
        n, groups = len(keys), int(a_group[-1]) + 1
        # a group begins where its first A token does
        first_a = np.flatnonzero(np.diff(a_group, prepend=-1))
        owner = np.searchsorted(unit_ends, (a_ends - self.a_size[a])[first_a], "right")
        n_a, n_b = np.bincount(a_group), np.bincount(b_group)
        counts = [np.bincount(owner, x, n) for x in (n_a, n_b, np.ones(groups), n_a * n_b)]
        units.counts.add(np.stack([*counts, np.ones(n)], 1).astype(np.int64).ravel())
        # what a unit's groups look like: A's ids, then B's, group by group
        a_code = a + np.where(np.diff(a_group, append=groups) > 0, self.a_last, 0)
        b_code = b + np.where(np.diff(b_group, append=groups) > 0, self.b_last, 0) + self.b_first
        by = np.argsort(np.concatenate((2 * a_group, 2 * b_group + 1)), kind="stable")
        written = [self.written[c] for c in np.concatenate((a_code, b_code))[by].tolist()]
        at = 0
        for end in np.cumsum(counts[0] + counts[1]).astype(np.int64).tolist():
            units.groups.append(b"".join(written[at:end])[:-1])
            at = end
        pair, times, group = linked_pairs(a, b, a_group, b_group)
        key = owner[group] << 32 | pair
        key, which = np.unique(key, return_inverse=True)
        before = units.pairs.n
        units.pairs.add(key & 0xFFFFFFFF)
        units.times.add(np.bincount(which, times))
        units.ends.add(before + np.searchsorted(key >> 32, np.arange(n), "right"))
        units.size += 2 * len(raw) + 12 * len(key) + 6 * (len(a) + len(b)) + 300 * n

    def units_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of the units of each text."""
        split = [self.keys(t) if t else [] for t in texts]
        known = self.units.number
        with many_objects():
            self.learn(list(set().union(*split).difference(known)))
        return [np.fromiter(map(known.__getitem__, keys), np.int32, len(keys)) for keys in split]

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of pairs of each unit, the pairs, how many links of each)."""
        ends, held = self.units.ends.all, self.units
        first = np.where(numbers > 0, ends[numbers - 1], 0)
        sizes = ends[numbers] - first
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return sizes, held.pairs.all[at], held.times.all[at]


class Chunk:
    """Counts, over some documents, how many of them hold each id pair."""

    def __init__(self) -> None:
        self.units: list[np.ndarray] = []
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting: list[np.ndarray] = []
        self.chars = self.due = 0

    def add(self, aligner: Aligner, numbers: np.ndarray, chars: int) -> None:
        self.waiting.append(np.unique(numbers))
        self.chars += chars
        self.due += chars
        if self.due >= SORTED:
            self.count(aligner)

    def count(self, aligner: Aligner) -> None:
        """Count the pairs of the waiting documents, each pair once a document."""
        if not self.waiting:
            return
        numbers = np.concatenate(self.waiting)
        doc = np.repeat(np.arange(len(self.waiting)), [len(w) for w in self.waiting])
        sizes, pairs, _ = aligner.pairs_of(numbers)
        held = np.unique(np.repeat(doc, sizes) << 32 | pairs) & 0xFFFFFFFF
        self.found.append(np.unique(held, return_counts=True))
        self.units.append(np.unique(numbers))
        self.waiting, self.due = [], 0
        if len(self.found) >= 32:
            self.found, self.units = [self.counted()], [np.unique(np.concatenate(self.units))]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        pairs, which = np.unique(np.concatenate([p for p, _ in self.found] or [np.empty(0, np.int64)]), return_inverse=True)
        return pairs, np.bincount(which, np.concatenate([c for _, c in self.found] or [np.empty(0)])).astype(np.int64)

    def row(self, aligner: Aligner) -> dict:
        """The chunk's pairs and their counts, and the pairs of its units by place in that list."""
        self.count(aligner)
        pairs, docs = self.counted()
        units = np.unique(np.concatenate(self.units or [np.empty(0, np.int32)]))
        sizes, of_unit, times = aligner.pairs_of(units)
        return {
            "pairs": pairs, "docs": docs, "units": packed(np.diff(units, prepend=0)), "sizes": packed(sizes),
            "at": packed(np.searchsorted(pairs, of_unit)), "times": packed(times),
        }


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNKS = {"pairs": "array<int>", "docs": "array<bigint>", "sizes": "binary", "at": "binary", "times": "binary"}


def _aligned(batches: Iterator[dict], a_path: str, b_path: str) -> Iterator[dict]:
    """One row for each document, and after some of them one for their chunk."""
    from pyspark import TaskContext

    aligner = worker_memory(("token_alignment", a_path, b_path), lambda: Aligner(a_path, b_path))
    part, number, chunk = TaskContext.get().partitionId(), 0, Chunk()
    blank = [None]

    def finished() -> dict:
        row = chunk.row(aligner)
        if aligner.units.size > REMEMBERED:
            aligner.units = Units()
        out = {"chunk": [part << 32 | number], "key": blank, "groups": blank} | {c: blank for c in _COUNTS}
        return out | {k: [v] for k, v in row.items()}

    for b in batches:
        at = 0
        while at < len(b["key"]):
            end, chars = at, 0
            while end < len(b["key"]) and chars < SORTED:
                chars += len(b["body"][end] or "")
                end += 1
            texts = b["body"][at:end]
            out = {name: [] for name in ("units", "groups", *_COUNTS)}
            for text, numbers in zip(texts, aligner.units_of(texts)):
                counts = aligner.units.counts.all.reshape(-1, 5)[numbers]
                if not len(numbers) or not counts[:, 4].all():
                    numbers, counts = numbers[:0], counts[:0]
                for name, n in zip(_COUNTS, counts.sum(0).tolist()):
                    out[name].append(n)
                held = aligner.units.groups
                out["groups"].append(b";".join([held[i] for i in numbers.tolist()]))
                out["units"].append(packed(numbers))
                chunk.add(aligner, numbers, len(text or ""))
            n = end - at
            out["groups"] = pa.array(out["groups"], pa.binary()).cast(pa.string())
            yield {"chunk": [part << 32 | number] * n, "key": b["key"][at:end]} | out | {c: blank * n for c in _CHUNKS}
            at = end
            if chunk.chars >= CHUNK or aligner.units.size > REMEMBERED:
                yield finished()
                number, chunk = number + 1, Chunk()
    if chunk.chars:
        yield finished()


def _summed(key: tuple, documents: pa.Table, counted: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's documents, from the counts of its pairs."""
    is_chunk = documents["sizes"].is_valid()
    docs, chunks = documents.filter(pa.compute.invert(is_chunk)), documents.filter(is_chunk)
    units = [unpacked(x) for x in docs["units"].to_pylist()]
    sums = {"n_best": np.zeros(len(units), np.int64), "count_sum": np.zeros(len(units), np.int64)}
    if len(chunks) and sum(map(len, units)):
        known, sizes, at, times = (unpacked(chunks[name][0].as_py()) for name in ("units", "sizes", "at", "times"))
        place, ends = np.searchsorted(np.cumsum(known), np.concatenate(units)), np.cumsum(sizes)
        doc_ends = np.cumsum([len(u) for u in units])
        for name in sums:
            value = np.zeros(len(counted), np.int64)
            value[counted["pos"].to_numpy()] = counted[name].to_numpy()
            upto = np.concatenate(([0], np.cumsum(value[at] * times)))
            of_unit = np.diff(upto[ends], prepend=0)
            upto = np.concatenate(([0], np.cumsum(of_unit[place])))
            sums[name] = np.diff(upto[doc_ends], prepend=0)
    kept = docs.select(["key", *_COUNTS, "groups"])
    for name, values in sums.items():
        kept = kept.append_column(name, pa.array(values))
    return kept


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: Callable[[Column], Column] = lambda g: g,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every whole text.

    A is a byte-level tokenizer file and encodes a space and the text, B a sentencepiece
    model, which adds the space itself; both without special tokens. Tokens are taken as
    byte ranges; where an A and a B token end at the same byte a group ends. Links are all
    pairs of an A and a B token of one group. An id pair's count is the number of documents
    of the whole table that hold it as a link; `n_best` are the links whose count is the
    highest of their A id, ties included, `count_sum` is the sum of the counts over links.
    `groups` is written `a1,a2|b1;a3|b2,b3`; the argument of that name may turn the text
    into something shorter before it is stored.

    A text that is NULL or empty, or that a tokenizer does not give back byte by byte, has
    no tokens: zeros and an empty `groups`. Repeated and NULL ids stay documents of their
    own, other columns are not read, no rows give no rows.

    Documents go through the tokenizers once, CHUNK characters at a time. A chunk leaves its
    documents' units and its distinct id pairs with their counts in the shared folder; only
    the distinct pairs of chunks are shuffled to be added up, and the sums go back to their
    chunk, where they meet its documents. No pair is sent for each link, nothing is
    broadcast by hint, and a pair that all documents hold has one row for each chunk.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["key"]
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    schema = f"chunk bigint, key {kind}, {counts}, groups string, units binary, " + ", ".join(f"{k} {v}" for k, v in _CHUNKS.items())
    found = map_batches(rows, lambda batches: _aligned(batches, a_path, b_path), schema)
    found = settle(found.withColumn("groups", groups(F.col("groups"))), "aligned")
    each = found.where("pairs is not null").select(
        F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("pairs", "docs"))
    )
    each = each.select("of", "pos", "col.pairs", "col.docs")
    total = each.groupBy("pairs").agg(F.sum("docs").alias("count_sum")).withColumn("a", F.expr(f"pairs div {B_IDS}"))
    highest = F.max("count_sum").over(Window.partitionBy("a"))
    total = total.select("pairs", "count_sum", (F.col("count_sum") == highest).cast("bigint").alias("n_best"))
    counted = each.join(total, "pairs").select("of", "pos", "n_best", "count_sum")
    out = f"key {kind}, {counts}, groups {dict(found.dtypes)['groups']}, n_best bigint, count_sum bigint"
    slim = found.drop("pairs", "docs")
    done = slim.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(_summed, out)
    return done.withColumnRenamed("key", id_col)
