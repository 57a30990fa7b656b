"""Bounded-space online packing of tokenised documents into sequences."""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import many_objects, map_batches, settle, worker_memory

WINDOW = 2048
OPEN_WINDOWS = 32
#: A window with less free room than this is given out as it is: a cut there would
#: leave a sliver of a document.
SLIVER = 4
#: Leftover windows of so many partitions meet in one task.
MERGED_PARTITIONS = 64
END_ID = 1
REMEMBERED = 1_000_000


class WordIds:
    """Ids of a text by the tokenizer file, remembered by word.

    The file's normaliser and split pattern work inside stretches without spaces, tabs
    and line ends (they drop white space), so the ids of a text are those of its
    stretches, one after the other. A word of plain letters with marks after it has two
    parts, the letters and the marks. New letter parts go to the library many at a time:
    the last id of each of them is one with a word end.
    """

    def __init__(self, path: str) -> None:
        import re

        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends_part = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.plain = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
        self.known: dict[str, bytes] = {"": b""}

    def _learn(self, words: set[str]) -> None:
        import numpy as np

        known, parts, others = self.known, [], []
        for word in words:
            # letters in lower case and the marks after them, as the file's rules part them
            stem = word.rstrip(".,;:!?")
            if len(word) < 40 and (stem.isascii() and stem.isalpha() or self.plain(stem)):
                parts.append((word, stem.lower(), word[len(stem) :]))
            else:
                others.append(word)
        joined = list({stem for _, stem, _ in parts}.difference(known))
        others += {marks for _, _, marks in parts}.difference(known)
        for begin in range(0, len(joined), 1000):
            chunk = joined[begin : begin + 1000]
            found = self.tokenizer.encode_batch_fast([" ".join(chunk)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<i4")
            ends = 4 * (np.flatnonzero(self.ends_part[ids]) + 1)
            if len(ends) == len(chunk):
                packed, at = ids.tobytes(), 0
                for stem, end in zip(chunk, ends.tolist()):
                    known[stem] = packed[at:end]
                    at = end
            else:
                others += chunk
        if others:
            for word, found in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
                known[word] = np.array(found.ids, "<i4").tobytes()
        for word, stem, marks in parts:
            known[word] = known[stem] + known[marks]

    def ids_of(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as 32-bit integers; the new words of about a million characters
        are learnt together."""
        begin = 0
        while begin < len(texts):
            split, chars = [], 0
            while begin + len(split) < len(texts) and chars < 1_000_000:
                text = texts[begin + len(split)] or ""
                chars += len(text)
                split.append(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
            distinct = set().union(*split)
            if len(self.known) + len(distinct) > REMEMBERED:
                self.known.clear()
                self.known[""] = b""
            known = self.known
            with many_objects():
                self._learn(distinct.difference(known))
            for words in split:
                yield b"".join(map(known.__getitem__, words))
            begin += len(split)


def word_ids(path: str) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_memory(("packing", path), lambda: WordIds(path))


class OpenWindows:
    """A fixed number of open windows, the pieces in them, and those given out."""

    def __init__(self, window: int, most: int, sliver: int) -> None:
        self.window, self.most, self.sliver = window, most, sliver
        self.free: list[tuple[int, int]] = []  # (room, window), sorted
        self.held: dict[int, list[tuple]] = {}
        self.full: list[list[tuple]] = []
        self.count = 0

    def give_out(self, number: int) -> None:
        self.full.append(self.held.pop(number))

    def put(self, key: tuple, start: int, ids: bytes) -> None:
        """Place a piece best-fit; if no window has the room, fill the fullest one up and
        give it out, then go on with what is left of the piece."""
        while ids:
            size = len(ids) // 4
            if size >= self.window:
                self.full.append([(key, start, ids[: 4 * self.window])])
                start, ids = start + self.window, ids[4 * self.window :]
                continue
            at = bisect_left(self.free, (size, -1))
            if at < len(self.free):
                room, number = self.free.pop(at)
                self._add(number, room, key, start, ids)
                return
            if len(self.free) < self.most:
                self.held[self.count] = []
                self._add(self.count, self.window, key, start, ids)
                self.count += 1
                return
            room, number = self.free.pop(0)
            if room >= self.sliver:
                self.held[number].append((key, start, ids[: 4 * room]))
                start, ids = start + room, ids[4 * room :]
            self.give_out(number)

    def _add(self, number: int, room: int, key: tuple, start: int, ids: bytes) -> None:
        self.held[number].append((key, start, ids))
        left = room - len(ids) // 4
        if left:
            insort(self.free, (left, number))
        else:
            self.give_out(number)


PIECES = "key {kind}, total bigint, start bigint, ids binary, sequence_id bigint, offset bigint, used bigint"


def _rows(windows: list[list[tuple]], first: int, step: int = 1) -> dict:
    out = {n: [] for n in ("key", "total", "start", "ids", "sequence_id", "offset", "used")}
    for number, pieces in enumerate(windows):
        offset, used = 0, sum(len(ids) for _, _, ids in pieces) // 4
        for (key, total), start, ids in pieces:
            for name, value in zip(out, (key, total, start, ids, first + number * step, offset, used)):
                out[name].append(value)
            offset += len(ids) // 4
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    sliver: int = SLIVER,
) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` ids.

    A document is its ids by the `tokenizer` file and then END_ID; a NULL or empty text is
    END_ID alone. Rows with repeated or NULL ids are documents of their own. Returns
    (id, doc_tokens, start, ids binary of little-endian 32-bit ids, length, sequence_id,
    offset, padded_to): `padded_to` is the length itself where it is a power of two, else
    `window`. No documents give no pieces.

    Each partition keeps `open_windows` windows open. Windows that are open at its end go
    to a second step, in which those of MERGED_PARTITIONS partitions (a bounded number of
    ids) are packed again; what is open after that is cut at powers of two, so it needs no
    padding. Rows of the first step are written to the shared folder before the second
    reads them: a task that runs again cannot mix two packings.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["key"]
    pieces = PIECES.format(kind=kind)

    def first(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tokens, windows, given = word_ids(tokenizer), OpenWindows(window, open_windows, sliver), 0
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            for key, found in zip(b["key"], tokens.ids_of(b["body"])):
                ids = found + end
                windows.put((key, len(ids) // 4), 0, ids)
                if len(windows.full) >= 512:
                    yield _rows(windows.full, part << 32 | given)
                    given += len(windows.full)
                    windows.full.clear()
        yield _rows(windows.full, part << 32 | given)
        rest = [windows.held[n] for n in sorted(windows.held)]
        yield _rows(rest, -(part + 1), 0)

    placed = settle(map_batches(rows, first, pieces), "pieces")
    open_rows = placed.where("sequence_id < 0")
    groups = open_rows.withColumn("bundle", F.floor(-F.col("sequence_id") / MERGED_PARTITIONS))

    def second(key, table):
        windows = OpenWindows(window, open_windows, 1)
        table = table.sort_by([("sequence_id", "descending"), ("total", "descending"), ("key", "ascending"), ("start", "ascending"), ("offset", "ascending")])
        for row in table.select(["key", "total", "start", "ids"]).to_pylist():
            windows.put((row["key"], row["total"]), row["start"], row["ids"])
        # what is still open: one stream of ids, cut into full windows and powers of two
        stream = [p for n in sorted(windows.held) for p in windows.held[n]]
        left = sum(len(ids) // 4 for _, _, ids in stream)
        lengths = [window] * (left // window)
        lengths += [1 << b for b in range(window.bit_length(), -1, -1) if left % window >> b & 1]
        for length in lengths:
            chosen = []
            while length:
                owner, start, ids = stream.pop(0)
                take = min(length, len(ids) // 4)
                chosen.append((owner, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    stream.insert(0, (owner, start + take, ids[4 * take :]))
                length -= take
            windows.full.append(chosen)
        import pyarrow as pa

        out = _rows(windows.full, (1 << 62) + (key[0].as_py() << 32))
        return pa.table({n: pa.array(out[n], table.schema.field(n).type) for n in out})

    merged = groups.groupBy("bundle").applyInArrow(second, pieces)
    found = placed.where("sequence_id >= 0").unionByName(merged)
    return found.select(
        F.col("key").alias(id_col),
        F.col("total").alias("doc_tokens"),
        "start",
        "ids",
        (F.octet_length("ids") / 4).cast("bigint").alias("length"),
        "sequence_id",
        "offset",
        F.when(F.bit_count("used") == 1, F.col("used")).otherwise(F.lit(window).cast("bigint")).alias("padded_to"),
    )
