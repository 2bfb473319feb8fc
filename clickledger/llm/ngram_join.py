"""Operator 10: n-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per distinct shingle set and a column per shingle; its product with its own
transpose holds the overlaps. Only blocks that can hold a link are multiplied:

1. A set is cut by hash range into more parts than two linked sets of its size class can differ in elements, so a known number of
   parts is equal in both (the pigeonhole of Arasu et al., 2006); small sets are cut into their elements. A
   signature is the hash of one part. Of a set's signatures the rarest are kept, as many as make sure that two linked sets keep one in common (prefix
   filtering, Chaudhuri et al., 2006): a signature that only one set has comes first and costs nothing, one that very
   many sets have comes last and is hardly ever kept. Sets that keep a signature in common are tied into candidate groups.
2. A candidate group is dealt into blocks of bounded rows and elements; every pair of blocks is one small
   sparse product, made column range by column range. Overlaps add up, and rows and pairs are
   discarded once the rest of the columns cannot lift them to the bound that their sizes set.
3. Links leave a block product as a spanning forest, so a group of n near copies gives fewer than n rows a
   block pair and no list of pairs. Components of these links are those of all links.

Sets are known by the number of one row that has them, not by a document's key: rows that repeat a key with other texts are sets of
their own, tied to each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import drop_stored, give_back, stored
from clickledger.llm.components import components, with_least

_U64 = np.uint64
#: Bounds of one block of a candidate group: sets, and elements of all of them.
BLOCK_SETS = 512
BLOCK_ELEMENTS = 1_000_000
#: Rows that one task of the block products should get.
TASK_ROWS = 4096
#: Sets of fewer elements, and their partners, are cut into elements.
SMALL = 32
#: Columns that a product multiplies at a time.
COLUMNS = 2048
#: Words that a task remembers hashes of.
WORDS = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text; shorter texts are one shingle, no words give none."""

    def __init__(self, n: int):
        self.n, self.words = n, _WordHash()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
        k = len(words)
        if not k:
            return np.zeros(0, _U64)
        h = np.fromiter(map(self.words.__getitem__, words), _U64, k)
        width = min(k, self.n)
        with np.errstate(over="ignore"):
            out = np.full(k - width + 1, _U64(width), _U64)
            for i in range(width):
                out = _mix(out * _U64(0x9E3779B97F4A7C15) + h[i : k - width + 1 + i])
        return np.unique(out)


class Classes:
    """Size classes and their numbers of parts for a threshold of `percent` hundredths. A pair of sets meets in the class of its smaller one; class -1 are the small sets."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("a percentage")
        self.p = percent
        self.ratio = max(100 / percent, 1.6) + 1e-9  # wider classes need more parts, narrower ones have more sets in two of them

    @lru_cache(maxsize=None)  # noqa: B019
    def low(self, c: int) -> int:
        return 1 if c < 0 else SMALL if c == 0 else int(self.low(c - 1) * self.ratio) + 1

    @lru_cache(maxsize=None)  # noqa: B019
    def of(self, n: int) -> int:
        c = -1
        while self.low(c + 1) <= n:
            c += 1
        return c

    def differ(self, a: int, b: int) -> int:
        """Most elements in which linked sets of these sizes can differ."""
        return (a + b) * (100 - self.p) // (100 + self.p)

    @lru_cache(maxsize=None)  # noqa: B019
    def parts(self, c: int) -> int:
        """Parts for sets whose smaller partner is of class c; 0 where linked sets are equal."""
        low, top = self.low(c), self.low(c + 1) - 1
        d = self.differ(top, top * 100 // self.p)
        if d == 0:
            return 0

        def enough(k: int) -> bool:
            """Several equal parts are sure for every size, counting out the parts that are empty by chance."""
            return all(k - self.differ(n, n * 100 // self.p) >= 1 + d // 16 + 1.5 * k * np.exp(-n / k) + (k > 8) for n in (low, (low + top) // 2, top))

        k = d + 1
        while not enough(k) and k < 4 * d + 8:
            k += 1
        return k

    @lru_cache(maxsize=None)  # noqa: B019
    def roles(self, n: int) -> tuple[tuple[int, int, int], ...]:
        """(class, parts, parts sure to be equal in both) of the classes in which a set of n elements can meet a partner. Class -1 has a part per element."""
        out, c, least = [], self.of(n), -(-n * self.p // 100)  # least: size of the smallest partner, and of the smallest overlap
        if c < 0:
            if least < n or self.differ(n, n * 100 // self.p):
                out.append((-1, n, least))
            return tuple(out)
        if k := self.parts(c):
            out.append((c, k, k - self.differ(n, n * 100 // self.p)))
        if least < self.low(c):
            if c == 0:
                out.append((-1, n, least))
            elif k := self.parts(c - 1):
                out.append((c - 1, k, k - self.differ(n, self.low(c) - 1)))
        return tuple(out)


def signatures(h: np.ndarray, classes: Classes) -> list[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(class, parts sure to be equal, empty parts, signatures of the others, signatures of the empty ones) of a sorted set in each of its classes.

    The signatures of empty parts are given only where all sure parts could be empty ones.
    """
    out = []
    none = np.zeros(0, _U64)
    total = None
    for c, k, sure in classes.roles(len(h)):
        if c < 0:
            out.append((c, sure, 0, _mix(h ^ _U64(0xA5A5A5A5A5A5A5A5)), none))
            continue
        if total is None:
            with np.errstate(over="ignore"):
                total = np.concatenate([np.zeros(1, _U64), np.cumsum(_mix(h))])
        part = ((h >> _U64(32)) * _U64(k)) >> _U64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        last = np.append(first[1:], len(h))
        with np.errstate(over="ignore"):
            own = _mix((total[last] - total[first]) ^ _mix(part[first] + _U64(c * 0x100000001 + 1)))
            empty = k - len(first)
            absent = _mix(_mix(np.setdiff1d(np.arange(k, dtype=_U64), part[first]) + _U64(c * 0x100000001 + 1))) if empty >= sure else none
        out.append((c, sure, empty, own, absent))
    return out


_ROLES = "array<struct<role:int,sure:int,empty:int,sigs:array<bigint>,absent:array<bigint>>>"


def shingle_sets(df: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(doc, mark, n_shingles, h1, h2, roles): a row's key, a hash of its text, its set's size, a 128-bit hash of the set and its signatures by class."""
    kind = df.schema[key].dataType.simpleString()
    number = pa.list_(pa.int64())
    role = pa.struct([("role", pa.int32()), ("sure", pa.int32()), ("empty", pa.int32()), ("sigs", number), ("absent", number)])

    def lists(parts: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)))

    def run(batches):
        shingle, classes = Shingler(n), Classes(percent)
        for b in batches:
            size, h1, h2, ends, found = [], [], [], [0], []
            for t in b.column(2):
                s = shingle(t.as_py())
                d = xxhash.xxh3_128_digest(s.tobytes())
                size.append(len(s))
                h1.append(int.from_bytes(d[:8], "little", signed=True))
                h2.append(int.from_bytes(d[8:], "little", signed=True))
                found += signatures(s, classes) if len(s) else []
                ends.append(len(found))
            flat = pa.StructArray.from_arrays([*(pa.array([x[i] for x in found], pa.int32()) for i in range(3)), lists([x[3] for x in found]), lists([x[4] for x in found])], fields=list(role))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc", "mark", "n_shingles", "h1", "h2", "roles"])
            give_back()

    return df.select(df[key].alias("doc"), F.xxhash64(df[text]).alias("mark"), df[text].alias("_text")).mapInArrow(run, f"doc {kind}, mark bigint, n_shingles bigint, h1 bigint, h2 bigint, roles {_ROLES}")


def set_nodes(sets: DataFrame) -> DataFrame:
    """(h1, h2, n_shingles, doc, mark, node): one row per distinct set; node is the number of the row that stands for it, one with the smallest key. sets: a stored shingle_sets() with row numbers."""
    known = sets.where("n_shingles > 0 and doc is not null")
    return known.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc", "row", "mark")).alias("s")).select("h1", "h2", "n_shingles", "s.doc", "s.mark", F.col("s.row").alias("node"))


def candidate_ties(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): ties between sets that may link, each set to the smallest one with which it keeps a signature in common.

    Rows that repeat a set are left out by their numbers, a stored table: as long as it is small the planner sends it to the signatures, beyond that both
    are shuffled. The signatures themselves are shuffled twice at any size, to be counted and to meet their counts.
    """
    rows = sets.where("size(roles) > 0 and doc is not null")
    copies = stored(rows.select("row").join(nodes.select(F.col("node").alias("row")), "row", "left_anti"), "set-copies")
    own = rows.select("row", "roles").join(copies, "row", "left_anti").select(F.col("row"), F.posexplode("roles").alias("i", "r"))
    # A set and one of its at most two classes in one number; spare: empty parts less those that are sure to be equal.
    own = own.select((F.col("row") * 2 + F.col("i")).alias("as"), (F.col("r.empty") - F.col("r.sure")).alias("spare"), "r.sigs", "r.absent")
    signed = own.select("as", "spare", F.explode("sigs").alias("sig"))
    shared = signed.groupBy("sig").agg(F.count("*").alias("sets")).where("sets > 1")
    # The global order is by frequency, then signature; signatures of one set come first, of empty parts last.
    ordered = signed.join(shared.hint("merge"), "sig").groupBy("as", "spare").agg(F.array_sort(F.collect_list(F.struct("sets", "sig"))).alias("s"))
    length = F.least(F.size("s") + F.col("spare") + 1, F.size("s"))
    kept = ordered.where(length > 0).select(F.explode(F.slice("s", F.lit(1), length)).alias("k"), "as").select(F.col("k.sig").alias("a"), F.shiftright("as", 1).alias("b"))
    absent = own.where("spare >= 0").select(F.explode(F.slice(F.array_sort("absent"), F.lit(1), F.col("spare") + 1)).alias("a"), F.shiftright("as", 1).alias("b"))
    met = stored(kept.unionByName(absent), "kept-signatures")
    ties = stored(with_least(met).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "ties")
    drop_stored(met)
    return ties


def product_links(sets: list[np.ndarray], split: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets[:split] and sets[split:], or within all sets if split is 0, as (index, smallest index of its tree)."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), size)
    side = np.zeros(m, bool) if not split else np.arange(m) >= split
    least = -(-size * percent // 100)  # an overlap with any partner reaches this share of the own size
    while True:  # drop columns of one row only, then rows that cannot reach their bound, until both are stable
        if not len(col):
            return []
        held = np.bincount(col)[col] > 1
        col, row = col[held], row[held]
        weak = np.bincount(row, minlength=m) < np.maximum(least, 1)
        keep = ~weak[row]
        if keep.all():
            break
        col, row = col[keep], row[keep]
    live = np.flatnonzero(np.bincount(row, minlength=m) > 0)
    left = live[~side[live]]
    right = live[side[live]] if split else left
    if not len(left) or not len(right):
        return []
    _, col = np.unique(col, return_inverse=True)
    at = np.full(m, -1)
    at[left] = np.arange(len(left))
    at_r = at if not split else np.full(m, -1)
    if split:
        at_r[right] = np.arange(len(right))
    sl, sr = size[left], size[right]
    need = -(-(sl[:, None] + sr[None, :]) * percent // (100 + percent))  # the overlap that makes a link
    over = np.zeros(need.shape, np.float32)
    rest_l, rest_r = np.bincount(row, minlength=m)[left], np.bincount(row, minlength=m)[right]
    alive = (np.minimum(sl[:, None], sr[None, :]) >= need)
    width = int(col.max()) + 1
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    for a in range(0, width, COLUMNS):
        x, y = np.searchsorted(col, [a, a + COLUMNS])
        c, r = col[x:y] - a, row[x:y]
        in_l = at[r] >= 0
        on_l = np.zeros((len(left), COLUMNS), np.float32)
        on_l[at[r[in_l]], c[in_l]] = 1
        if split:
            in_r = at_r[r] >= 0
            on_r = np.zeros((len(right), COLUMNS), np.float32)
            on_r[at_r[r[in_r]], c[in_r]] = 1
        else:
            on_r = on_l
        over += on_l @ on_r.T
        rest_l = rest_l - on_l.sum(1, dtype=np.int64)
        rest_r = rest_r - on_r.sum(1, dtype=np.int64)
        alive &= over + np.minimum(rest_l[:, None], rest_r[None, :]) >= need
        if not alive.any():
            return []
    link = alive & (over >= need)
    return _forest(link, left, right)


def _forest(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """(index, smallest index of its tree) from a matrix of links between left and right."""
    out, seen_l, seen_r, same = [], np.zeros(len(left), bool), np.zeros(len(right), bool), left is right
    for start in np.flatnonzero(link.any(1)):
        if seen_l[start]:
            continue
        tree_l, tree_r = np.zeros(len(left), bool), np.zeros(len(right), bool)
        tree_l[start] = True
        front = tree_l.copy()
        while front.any():
            reach = link[front].any(0) & ~tree_r
            tree_r |= reach
            back = (reach if same else link[:, reach].any(1)) & ~tree_l
            tree_l |= back
            front = back
        seen_l |= tree_l
        seen_r |= tree_r
        nodes = np.unique(np.concatenate([left[tree_l], right[tree_r]]))
        out += [(int(x), int(nodes[0])) for x in nodes[1:]]
    return out


def _block_products(percent: int):
    """Rows (group, bi, bj, blk, node, elements) sorted by group, bi, bj -> links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, {}

        def links():
            names, sets = [], []
            parts = sorted(sides)
            for blk in parts:
                for node, s in sorted(sides[blk].items()):
                    names.append(node)
                    sets.append(s)
            if len(sets) < 2 or (now[1] != now[2] and len(parts) < 2):
                return []
            split = len(sides[parts[0]]) if now[1] != now[2] else 0
            return [(names[i], names[j]) for i, j in product_links(sets, split, percent)]

        for b in batches:
            found = []
            cols = [b.column(i).to_pylist() for i in range(5)]
            data = b.column(5)
            for i, (g, bi, bj, blk, node) in enumerate(zip(*cols, strict=True)):
                if (g, bi, bj) != now:
                    if now is not None:
                        found += links()
                    now, sides = (g, bi, bj), {}
                sides.setdefault(blk, {})[node] = np.frombuffer(data[i].as_py(), _U64)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])
        if now is not None:
            found = links()
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return run


def jaccard_links(df: DataFrame, sets: DataFrame, nodes: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(a, b): links between different sets, a spanning forest per block pair."""
    spark = df.sparkSession
    tied = components(candidate_ties(sets, nodes))
    roots = tied.select(F.col("root").alias("node"), "root").distinct()
    members = tied.union(roots).join(nodes.select("node", "doc", "mark", F.col("n_shingles").alias("n")), "node")
    dims = members.groupBy("root").agg(F.count("*").alias("sets"), F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
    placed = stored(members.join(dims, "root").select("node", "doc", "mark", "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("blk")), "placed-sets")
    texts = df.select(df[key].alias("doc"), F.xxhash64(df[text]).alias("mark"), df[text].alias("_text")).join(placed.hint("merge"), ["doc", "mark"]).select("root", "blocks", "blk", "node", "_text")

    def shingled(batches):
        shingle = Shingler(n)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([shingle(t.as_py()).tobytes() for t in b.column(4)], pa.binary())], names=["root", "blocks", "blk", "node", "elements"])
            give_back()

    rows = texts.mapInArrow(shingled, "root bigint, blocks int, blk int, node bigint, elements binary")
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("root", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"), "blk", "node", "elements")
    count = placed.agg(F.sum("blocks").cast("long")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // TASK_ROWS))
    grouped = dealt.repartition(parts, "root", "bi", "bj").sortWithinPartitions("root", "bi", "bj")
    return grouped.mapInArrow(_block_products(percent), "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of df: key, n_shingles, component_id (the smallest key that links lead to).

    Words are separated by ASCII white space, A-Z are lower-cased, a set holds the distinct n-word shingles; fewer words
    are one shingle. Sets link when 100 * intersection >= percent * union. Null, empty or wordless texts have no
    shingles and link with nothing. A null key has a null component and links with nothing. Rows that repeat
    a key are one document: each has its own n_shingles, what links with one of them links with the document, and all have its component. Keys are
    of any type with an order. An empty table gives no rows; other columns are not read. Shingles are compared by
    64-bit and whole sets by 128-bit hashes.
    """
    sets = stored(shingle_sets(df, key, text, n, percent).withColumn("row", F.monotonically_increasing_id()), "shingle-sets")
    nodes = stored(set_nodes(sets), "set-nodes")
    of_set = ["h1", "h2", "n_shingles"]
    facts = sets.select("doc", *of_set)
    known = facts.where("n_shingles > 0 and doc is not null")
    # Documents of several sets: their sets are one.
    several = known.groupBy("doc").agg(F.min(F.struct(*of_set)).alias("x"), F.max(F.struct(*of_set)).alias("y")).where("x <> y").select("doc")
    own = known.join(several, "doc", "left_semi").distinct().join(nodes.select(*of_set, "node"), of_set)
    same = own.join(own.groupBy("doc").agg(F.min("node").alias("first")), "doc").select(F.col("node").alias("a"), F.col("first").alias("b"))
    linked = components(jaccard_links(df, sets, nodes, key, text, n, percent).union(same))
    rooted = nodes.join(linked, "node", "left").select(*of_set, F.coalesce("root", "node").alias("a"), F.col("doc").alias("b"))
    named = stored(with_least(rooted).select(*of_set, F.col("m").alias("component_id")), "components")
    found = facts.join(named, of_set, "left").withColumn("component_id", F.when(F.col("doc").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id")))
    # A row without shingles has the component of its document's other rows, if there are any.
    bare = found.where("n_shingles = 0 and doc is not null").select("doc")
    others = known.join(bare, "doc", "left_semi").join(named, of_set).groupBy("doc").agg(F.min("component_id").alias("_other"))
    return found.join(others, "doc", "left").select(F.col("doc").alias(key), "n_shingles", F.coalesce("component_id", "_other", "doc").alias("component_id"))
