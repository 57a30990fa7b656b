"""N-gram Jaccard join by prefix trees over globally ordered shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import components, map_batches, settle, worker_memory

WORDS = 5
#: Similarity in per cent.
SIMILARITY = 80
#: The commonest shingles are ordered last; so many of them travel with the tasks (8 bytes each).
COMMON = 16_384
COMMON_FROM = 32
#: Classes under a shingle that are counted pair by pair; more of them meet in tries at once.
SMALL = 64
#: Sets that meet in one trie at most; larger groups are met block by block.
BLOCK = 1024
#: Instead of a second block, for the bags of candidates and for the partners of one class.
BAG, HUB = -1, -2
REMEMBERED = 1_000_000


def _word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    known = worker_memory("jaccard_trie", dict)
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        new = set(words).difference(known)
        known.update(zip(new, map(xxh3_64_intdigest, new)))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """63-bit hashes of the distinct word n-grams, ascending.

    Only A-Z are lower-cased, words end at ASCII white space; fewer words than `words`
    are one shingle; without words there is none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = _word_hashes(found)
    n = min(words, len(found))
    size = len(found) - n + 1
    mixed = np.full(size, n, np.uint64)
    for i in range(n):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + size])
    return np.unique(mixed >> np.uint64(1))


def ordered(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The set in the global order: rare shingles by hash, then the common ones, rarest first.

    `common` are sorted hashes, each with its place in a second row. A common shingle
    becomes 2**63 plus its place, so that the order is that of the numbers.
    """
    if not len(common[0]):
        return tokens
    at = np.minimum(np.searchsorted(common[0], tokens), len(common[0]) - 1)
    is_common = common[0][at] == tokens
    if not is_common.any():
        return tokens
    return np.sort(np.where(is_common, common[1][at] | np.uint64(1 << 63), tokens))


def prefix_length(n: int, similarity: int) -> int:
    """Two sets that are similar enough share one of so many first shingles of either."""
    return n + 1 + (-similarity * n // 100)


class Trie:
    """A radix tree of ordered sets; a node's edge holds the shingles its sets share next.

    Sets lie side by side in the order of their shingles, so the sets below a node are an
    interval [low, high).
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        keys = [s.astype(">u8").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])
        common = [0] + [_common_prefix(a, b) for a, b in zip(self.sets, self.sets[1:])]
        self.common = np.array(common)

    def children(self, low: int, high: int, depth: int) -> tuple[int, list[tuple[int, int]]]:
        """Where the edge into the node ends, and the intervals of the nodes below."""
        if high - low == 1:
            return len(self.sets[low]), []
        inner = self.common[low + 1 : high]
        end = int(inner.min())
        cuts = [low, *(np.flatnonzero(inner == end) + low + 1).tolist(), high]
        return end, list(zip(cuts, cuts[1:]))


def _common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _overlap(probe: np.ndarray, edge: np.ndarray) -> int:
    at = np.searchsorted(probe, edge)
    at[at == len(probe)] = 0
    return int((probe[at] == edge).sum())


def trie_links(
    sets: list[np.ndarray],
    labels: list[int],
    probes: list[int],
    similarity: int = SIMILARITY,
    allowed: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Links (i, j) that join, as a forest, all sets that are connected by similar pairs.

    Only pairs of a set in `probes` with another set count, and of these only those that
    `allowed` marks, if it is given. Sets of one label are known to be connected. A probe walks the trie once, carrying its overlap with the shared edges;
    it leaves a subtree whose remaining shingles are too few for the overlap needed, or in
    which no set fits in size and is not connected to the probe already.
    """
    trie = Trie(sets)
    place = {original: i for i, original in enumerate(trie.order)}
    label = np.unique([labels[i] for i in trie.order], return_inverse=True)[1]
    tree = {}
    links = []
    for original in probes:
        at = place[original]
        probe, n = trie.sets[at], len(trie.sets[at])
        open_ = (label != label[at]) & (100 * np.minimum(trie.sizes, n) >= similarity * np.maximum(trie.sizes, n))
        if allowed is not None:
            open_ &= allowed[original, trie.order]
        stack = [(0, len(sets), 0, 0)] if open_.any() else []
        while stack:
            low, high, depth, overlap = stack.pop()
            sizes = trie.sizes[low:high]
            if not (open_[low:high] & (label[low:high] != label[at])).any():
                continue
            if (low, high) not in tree:
                tree[low, high] = (*trie.children(low, high, depth), int(sizes.min()), int(sizes.max()))
            end, below, least, most = tree[low, high]
            edge = trie.sets[low][depth:end]
            # a long edge is looked at in two steps, as most probes end among its first shingles
            first = max(16, most // 5 + 2 - depth)
            pieces = (edge[:first], edge[first:])
            passed = depth
            for piece in pieces:
                if not len(piece):
                    continue
                overlap += _overlap(probe, piece)
                passed += len(piece)
                left = n - int(np.searchsorted(probe, piece[-1], "right"))
                # the overlap needed is similarity / (100 + similarity) of both sizes
                if (100 + similarity) * (overlap + most - passed) < similarity * (n + most) or (
                    100 + similarity
                ) * (overlap + left) < similarity * (n + least):
                    break
            else:
                if below:
                    stack += [(a, b, end, overlap) for a, b in below]
                elif (100 + similarity) * overlap >= similarity * (n + most):
                    links.append((original, trie.order[low]))
                    label[label == label[low]] = label[at]
    return links


def _sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The ids, the texts, and a digest that tells rows with one id apart."""
    body = F.col(text_col)
    return docs.select(F.col(id_col).alias("key"), body.alias("body"), F.coalesce(F.md5(body), F.lit("")).alias("digest"))


def _identity(tokens: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    value = xxh3_64_intdigest(tokens.tobytes(), len(tokens))
    return value - (1 << 64) if value >> 63 else value


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: int = SIMILARITY,
    common_from: int = COMMON_FROM,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_shingles, component_id, component, text_md5) of every row: components of documents
    whose shingle sets have a Jaccard similarity of `similarity` per cent or more. `component`
    tells components apart where ids repeat (NULL: no shingles), `text_md5` their rows.

    Shingles are compared by 63-bit hashes. Rows with equal sets are one class, told by a
    64-bit hash of the set and its size. NULL and empty texts, and texts of white space,
    have no shingles and link with nothing: their component is their own id. The component
    id is the smallest id of the component; a NULL id counts only where there is no other.
    Repeated ids are rows of their own. Other columns are not read. No rows give no rows.

    1. Shingles that several documents of a task share are counted; the COMMON commonest
       come last in the global order. The order decides how much work there is, not what
       is found.
    2. Each class is dealt out under the first shingles of its set: similar sets share
       one. Under a shingle with at most `small` classes, pairs of fitting sizes are
       counted. A pair can be similar only if the first shingles that it shares (and all
       that may be uncounted, under larger groups) make up for those behind them.
    3. Such candidates form bags, and a bag joins a trie; so do classes under the rarest
       of their larger groups, in blocks of `block`. A bag beyond that meets hub by hub.
    4. Larger groups whose classes are not all connected by now meet again as pairs of
       blocks, so that no pair is left out and no task gets a group. Groups of many shingles
       of the same classes are one cluster there, so that their classes meet once and not
       under each shingle. Two blocks' pairs are sifted by counting, then joined by a trie.

    Links form a forest: pairs that are connected already are not compared.
    """
    rows = _sets(docs, id_col, text_col)
    kind = dict(rows.dtypes)["key"]

    def describe(batches: Iterator[dict]) -> Iterator[dict]:
        """A row for each text, and one for each first shingle that several classes of a task
        share, with their number."""
        held, seen = [], set()

        def counted() -> dict:
            tokens, times = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            tokens, times = _signed(tokens[times > 1]), times[times > 1]
            none = [None] * len(tokens)
            held.clear()
            return {"key": none, "digest": none, "n": none, "class": none, "token": tokens, "times": times}

        for b in batches:
            found = [shingles(t, words) for t in b["body"]]
            names = [_identity(s) for s in found]
            for name, tokens in zip(names, found):
                if len(tokens) and name not in seen:
                    seen.add(name)
                    held.append(tokens[: prefix_length(len(tokens), similarity)])
            none = [None] * len(found)
            sizes = [len(s) for s in found]
            yield {"key": b["key"], "digest": b["digest"], "n": sizes, "class": names, "token": none, "times": none}
            if sum(map(len, held)) > 4_000_000:
                yield counted()
        yield counted()

    both = settle(map_batches(rows, describe, f"key {kind}, digest string, n int, class bigint, token bigint, times bigint"), "shingle-sets")
    described = both.where("token is null").select("key", "digest", "n", "class")
    common = (
        both.where("token is not null")
        .groupBy("token").agg(F.sum("times").alias("n"))
        .where(F.col("n") >= common_from)
        .orderBy(F.desc("n"), "token").limit(COMMON)
        .collect()  # COMMON rows
    )
    by_hash = np.array(sorted((r.token, len(common) - i) for i, r in enumerate(common)), np.int64).reshape(-1, 2).T
    order = by_hash.astype(np.uint64)

    def deal(batches: Iterator[dict]) -> Iterator[dict]:
        seen = set()
        for b in batches:
            tokens, classes, sizes = [], [], []
            for text in b["body"]:
                found = shingles(text, words)
                if not len(found) or (name := _identity(found)) in seen:
                    continue
                seen.add(name)
                first = ordered(found, order)[: prefix_length(len(found), similarity)]
                tokens.append(first)
                classes.append(np.full(len(first), name, np.int64))
                sizes.append(np.full(len(first), len(found), np.int32))
            if tokens:
                yield {"token": _signed(np.concatenate(tokens)), "class": np.concatenate(classes), "n": np.concatenate(sizes)}

    def shared(batches: Iterator[dict]) -> Iterator[dict]:
        """Counted pairs of small groups, and members of larger ones.

        Rows come by shingle and size. At most `small` rows and the pairs of about a
        million are held.
        """
        held, counted, large = np.empty((3, 0), np.int64), PairCounts(similarity), None
        for b in batches:
            now = np.array([b["token"], b["n"], b["class"]], np.int64)
            if large is not None:
                more = int(np.searchsorted(now[0], large, "right"))
                yield large_rows(now[:, :more])
                now = now[:, more:]
                if not now.shape[1]:
                    continue
                large = None
            now = np.concatenate([held, now], axis=1)
            now = now[:, np.concatenate(([True], (now[:, 1:] != now[:, :-1]).any(0)))]
            last = int(np.searchsorted(now[0], now[0, -1]))
            yield large_rows(counted.add(now[:, :last], small))
            held = now[:, last:]
            if held.shape[1] > small:
                yield large_rows(held)
                large, held = held[0, 0], held[:, :0]
            if counted.size > 1_000_000:
                yield counted.rows()
        yield large_rows(counted.add(held, small))
        yield counted.rows()

    def large_rows(found: np.ndarray) -> dict:
        none = [None] * found.shape[1]
        return {"token": found[0], "a": found[2], "b": none, "na": found[1], "nb": none, "shared": none}

    dealt = map_batches(rows, deal, "token bigint, class bigint, n int")
    by_token = dealt.repartition("token").sortWithinPartitions("token", "n", "class").select("token", "class", "n")
    found = settle(
        map_batches(by_token, shared, "token bigint, a bigint, b bigint, na bigint, nb bigint, shared bigint", 10_000),
        "shingle-pairs",
    )
    large = found.where("token is not null").select("token", F.col("a").alias("class"))
    uncounted = large.groupBy("class").agg(F.count("*").alias("extra"))
    pairs = found.where("token is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    for side in "ab":
        pairs = pairs.join(uncounted.withColumnsRenamed({"class": side, "extra": f"extra_{side}"}), side, "left")
    needed = F.expr(f"({similarity} * (na + nb) + {99 + similarity}) div {100 + similarity}")
    behind = F.greatest(*[F.expr(f"({similarity} * {n} + 99) div 100 - 1") for n in ("na", "nb")])
    most = F.col("shared") + F.least(*[F.coalesce(f"extra_{side}", F.lit(0)) for side in "ab"])
    candidates = settle(pairs.where(most >= needed - behind).select("a", "b"), "shingle-candidates")

    # one row of a class, from which its set is made again
    classes = described.where("n > 0").groupBy("class").agg(F.min("key").alias("key"))
    live = candidates.select(F.explode(F.array("a", "b")).alias("class")).union(large.select("class")).distinct()
    wanted = live.join(classes, "class").select(F.col("key").alias("wanted"))

    def again(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = [shingles(t, words) for t in b["body"]]
            yield {"class": [_identity(s) for s in found], "tokens": [ordered(s, order).astype(">u8").tobytes() for s in found]}

    chosen = rows.join(wanted, F.col("key").eqNullSafe(F.col("wanted")), "left_semi").select("body")
    sets = settle(map_batches(chosen, again, "class bigint, tokens binary"), "shingle-tries")

    number = F.ceil(F.count("*") / block).cast("int").alias("blocks")
    counted = _bags(candidates, block)

    # common shingles are negative as signed numbers, and come last
    rarest = F.min(F.struct((F.col("token") < 0).alias("is_common"), "token"))["token"]
    first = large.groupBy("class").agg(rarest.alias("token"))
    salted = first.join(first.groupBy("token").agg(number), "token").withColumn(
        "block", F.pmod(F.xxhash64("class"), "blocks").cast("int")
    )
    salted = salted.select("class", "token", "block", F.col("block").alias("other"))
    meetings = counted.unionByName(salted).withColumn("label", F.col("class"))
    links = settle(_meet(meetings, sets, similarity), "shingle-links")
    label = components(links).withColumnsRenamed({"node": "class", "component": "label"})

    # pairs that share a counted shingle are candidates already if they can be similar, so in the
    # larger groups only those are left that share nothing but shingles of larger groups
    whole = large.distinct().join(label, "class", "left").withColumn("label", F.coalesce("label", "class"))
    whole = settle(whole, "shingle-labels")
    # groups of many shingles of the same classes become one cluster: that of their class with
    # the smallest hash
    mixed = whole.groupBy("token").agg(F.min(F.xxhash64("class")).alias("cluster"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = mixed.where("low <> high").select("token", "cluster")
    members = settle(whole.join(mixed, "token").select("cluster", "class", "label").distinct(), "shingle-clusters")
    halves = members.groupBy("cluster").agg(F.ceil(F.count("*") / max(1, block // 2)).cast("int").alias("blocks"))
    unsettled = members.join(halves, "cluster").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # a block meets itself and every other one
    met = unsettled.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("cluster").alias("token"), "class", "label", F.least("own", "partner").alias("block"), F.greatest("own", "partner").alias("other"), "own"
    )
    more = settle(_meet(met, sets, similarity, dense=True), "shingle-links")
    label = components(links.unionByName(more)).withColumnsRenamed({"node": "class", "component": "label"})

    named = classes.join(label, "class", "left").select("class", "key", F.coalesce("label", "class").alias("label"))
    smallest = named.groupBy("label").agg(F.min("key").alias("component_id"))
    of_class = named.join(smallest, "label").select("class", "component_id", "label")
    full = described.where("n > 0").join(of_class, "class").select("key", "n", "component_id", "label", "digest")
    bare = described.where("n = 0").select("key", "n", F.col("key").alias("component_id"), F.lit(None).cast("bigint").alias("label"), "digest")
    return full.unionByName(bare).select(
        F.col("key").alias(id_col), F.col("n").cast("bigint").alias("n_shingles"), "component_id",
        F.col("label").alias("component"), F.col("digest").alias("text_md5"),
    )


class PairCounts:
    """How many shingles pairs of classes share, as far as counted."""

    def __init__(self, similarity: int) -> None:
        self.similarity = similarity
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, rows: np.ndarray, small: int) -> np.ndarray:
        """Count the pairs of whole groups of at most `small` rows (shingle, size, class),
        sorted by shingle and size; gives back the rows of larger groups."""
        token, size, name = rows
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.empty(0, np.int64)
        width = np.diff(np.append(begin, len(token)))
        for w in np.unique(width[(width > 1) & (width <= small)]).tolist():
            place = begin[width == w][:, None] + np.arange(w)
            left, right = np.triu_indices(w, 1)
            left, right = place[:, left].ravel(), place[:, right].ravel()
            fits = 100 * size[left] >= self.similarity * size[right]
            left, right = left[fits], right[fits]
            swap = name[left] > name[right]
            left, right = np.where(swap, right, left), np.where(swap, left, right)
            self.parts.append(np.array([name[left], name[right], size[left], size[right], np.ones(len(left), np.int64)]))
            self.size += len(left)
        return rows[:, np.repeat(width > small, width)]

    def rows(self) -> dict:
        """The counts so far, which are then forgotten."""
        both = np.concatenate([np.empty((5, 0), np.int64), *self.parts], axis=1)
        self.parts, self.size = [], 0
        both = both[:, np.lexsort((both[1], both[0]))]
        new = np.flatnonzero(np.concatenate(([True], (both[:2, 1:] != both[:2, :-1]).any(0)))) if both.shape[1] else []
        shared = np.add.reduceat(both[4], new) if len(new) else []
        a, b, na, nb, _ = both[:, new] if len(new) else both
        return {"token": [None] * len(a), "a": a, "b": b, "na": na, "nb": nb, "shared": shared}


def _bags(candidates: DataFrame, block: int) -> DataFrame:
    """Where candidate pairs meet: (class, token, block, other), a bag of connected candidates
    at once, and a larger bag's pairs in parts of a block's size under one of the two."""
    number = F.ceil(F.count("*") / block).cast("int").alias("blocks")
    bag = components(candidates).withColumnsRenamed({"node": "class", "component": "token"})
    bags = bag.groupBy("token").agg(number)
    bagged = bag.join(bags.where("blocks = 1"), "token").select("class", "token", F.lit(0).alias("block"), F.lit(BAG).alias("other"))
    in_large = candidates.join(bag.join(bags.where("blocks > 1"), "token").select(F.col("class").alias("a")), "a")
    parts = in_large.join(in_large.groupBy("a").agg(number), "a")
    parts = parts.select(F.col("a").alias("token"), "b", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"))
    partners = parts.select(F.col("b").alias("class"), "token", "block", F.lit(HUB).alias("other"))
    hubs = parts.select(F.col("token").alias("class"), "token", "block", F.lit(HUB).alias("other")).distinct()
    return bagged.unionByName(partners).unionByName(hubs)


def similar_pairs(sets: list[np.ndarray], similarity: int, side: np.ndarray | None = None, columns: int = 2048) -> np.ndarray:
    """Which of the sets are similar, as a matrix; with `side`, only pairs of different sides.

    Shared shingles are counted as a product of 0/1 matrices, some columns at a time; only
    shingles that several of the sets hold have a column.
    """
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times[at] > 1
    at, owner = (np.cumsum(times > 1) - 1)[at[several]], owner[several]
    by = np.argsort(at, kind="stable")
    at, owner = at[by], owner[by]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        low, high = np.searchsorted(at, (first, first + columns))
        held = np.zeros((len(sets), columns), np.float32)
        held[owner[low:high], at[low:high] - first] = 1
        common += held @ held.T
    found = (100 + similarity) * common.astype(np.int64) >= similarity * (sizes[:, None] + sizes)
    np.fill_diagonal(found, False)
    return found if side is None else found & (side[:, None] != side)


def _meet(members: DataFrame, sets: DataFrame, similarity: int, dense: bool = False) -> DataFrame:
    """Links among the classes that meet under (token, block, other), as a forest. With `dense`
    a group is two blocks (or one with itself), told by `own`, of which only pairs of one and
    the other are looked at: all of them are sifted by counting before the trie joins them."""
    columns = ["token", "block", "other", "class", "label", "tokens", *(["own"] if dense else [])]
    met = members.join(sets, "class").select(*columns)
    met = met.repartition("token", "block", "other").sortWithinPartitions("token", "block", "other", "class")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        held: dict[int, tuple[int, np.ndarray, int]] = {}
        group = None
        for b in batches:
            ends: list[tuple[int, int]] = []
            sides = b["own"] if dense else [0] * len(b["class"])
            for *now, name, label, tokens, own in zip(*[b[c] for c in columns[:6]], sides):
                if now != group:
                    ends += _joined(held, similarity, dense)
                    held, group = {}, now
                held[name] = (label, np.frombuffer(tokens, ">u8").astype(np.uint64), own)
            if ends:
                yield {"a": [a for a, _ in ends], "b": [b for _, b in ends]}
        if ends := _joined(held, similarity, dense):
            yield {"a": [a for a, _ in ends], "b": [b for _, b in ends]}

    return map_batches(met, work, "a bigint, b bigint")


def _joined(held: dict[int, tuple[int, np.ndarray, int]], similarity: int, dense: bool) -> list[tuple[int, int]]:
    if len(held) < 2:
        return []
    names = list(held)
    labels, sets, sides = zip(*held.values())
    if len(set(labels)) == 1:
        return []
    allowed, probes = None, np.arange(len(names))
    if dense:
        side = np.array(sides)
        allowed = similar_pairs(list(sets), similarity, side if side.min() < side.max() else None)
        probes = np.flatnonzero(allowed.any(1))
    found = trie_links(list(sets), list(labels), probes.tolist(), similarity, allowed)
    return [(names[i], names[j]) for i, j in found]
