"""Deduplication of new batches against all that was accepted before.

Method: every item has a hash of its normalised content and hashes of its paragraphs, here content-defined runs of
words. Both lie in tables bucketed by hash. An admission hashes only the new items, sends their hashes to the buckets
and joins bucket by bucket: equal content hashes are full copies, shared paragraph hashes give the coverage by which
near copies are chosen, which are then verified word by word. The hashes of accepted items are appended to the buckets;
the history is neither hashed nor shuffled again.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.keys import canonical_sha256
from pagemill.llm.arrow import map_batches
from pagemill.llm.words import folded_codes
from pagemill.plans.stages import SharedFiles, salted_join, stored

#: A paragraph begins at words whose code is 0 in this many, and has at least LEAST_WORDS words.
EVERY, LEAST_WORDS = 5, 4
#: Buckets up to this size have all their pairs tested by length and bitmap; larger ones are split by rare words, which loses no repeat.
BUCKET = 4096
#: Bitmap of an item's words, 256 bits.
_MAP = ["s0", "s1", "s2", "s3"]
_MAPS = "s0 bigint, s1 bigint, s2 bigint, s3 bigint"
#: Least share of the larger item's paragraphs that near copies share. Of a text of which 20 % of the
#: words changed at random about 17 % of the paragraphs are left, of one with 15 % about 27 %.
COVERAGE = 0.06
_MUL, _MUL2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
_NO_BATCH = 1 << 22


def sequence_hashes(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, mul: np.uint64 = _MUL) -> np.ndarray:
    """A 64-bit hash of each stretch of codes; stretches follow one another and none is empty."""
    if not len(starts):
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()) + 1, mul | np.uint64(1), np.uint64))
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        h = np.add.reduceat(codes * powers[place], starts) * mul + sizes.astype(np.uint64)
        return (h ^ (h >> np.uint64(31))).view(np.int64)


def paragraph_hashes(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the content-defined runs of the words of each stretch, each hash once per row.

    A run goes from a boundary word to the first boundary at least LEAST_WORDS later, so that an edit changes
    only the runs that hold it; the ends of the text are boundaries.
    """
    n = len(codes)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mixed = codes * _MUL2
    marks = np.flatnonzero((mixed >> np.uint64(17)) % np.uint64(EVERY) == 0)
    marks = np.unique(np.concatenate([starts, marks]))
    row = np.searchsorted(starts, marks, "right") - 1
    after = np.append(marks, n)[np.searchsorted(marks, marks + LEAST_WORDS, "left")]
    end = np.minimum(after, (starts + sizes)[row])
    with np.errstate(over="ignore"):
        odd = _MUL | np.uint64(1)
        powers = np.cumprod(np.full(n + 1, odd, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:n])])
        shift = np.cumprod(np.full(n + 1, np.uint64(pow(int(odd), -1, 1 << 64)), np.uint64))
        h = (sums[end] - sums[marks]) * shift[marks]
        h = ((h ^ (h >> np.uint64(29))) * _MUL + (end - marks).astype(np.uint64)).view(np.int64)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))
    return row[new], h[new]


def order_number(batch: Column, key: Column) -> Column:
    """(batch, key) as one number that orders items, a null batch last: batches under 2**22, keys under 2**40, none negative.

    Other values raise an error, as they would be mixed up.
    """
    batch, key = batch.cast("bigint"), key.cast("bigint")
    fits = key.between(0, (1 << 40) - 1) & (batch.isNull() | batch.between(0, _NO_BATCH - 1))
    number = F.shiftleft(F.coalesce(batch, F.lit(_NO_BATCH)), 40) + key
    return F.when(fits | key.isNull(), number).otherwise(F.raise_error(F.lit("keys must lie in [0, 2**40), batches in [0, 2**22)")))


def key_of(o: str) -> Column:
    return F.col(o).bitwiseAND((1 << 40) - 1)


def batch_of(o: str) -> Column:
    return F.nullif(F.shiftright(o, 40).cast("int"), F.lit(_NO_BATCH))


def hash_items(items: DataFrame) -> DataFrame:
    """(o, content_hash, content_check, words, s0, s1, s2, s3) of (o, content): one row per row with any word; the others repeat nothing.

    words has the low 32 bits of the code of each word, s0 to s3 are a bitmap of them; the two content hashes are those of the whole codes.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        parts = list(map(folded_codes, b.column(1).to_pylist()))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 3
        take = np.flatnonzero(sizes)
        codes, sizes = np.frombuffer(b"".join(parts), np.uint64), sizes[take]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        words = pa.array(codes.astype(np.uint32).view(np.int32), pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32), pa.int32()), words)
        hashes = [pa.array(sequence_hashes(codes, starts, sizes, m), pa.int64()) for m in (_MUL, _MUL2)]
        maps = np.zeros((len(take), 256), np.uint8)
        maps[np.repeat(np.arange(len(take)), sizes), ((codes >> np.uint64(12)) & np.uint64(255)).astype(np.int64)] = 1
        maps = np.packbits(maps, axis=1).view(np.int64).T
        names = ["o", "content_hash", "content_check", "words", *_MAP]
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take, pa.int64())), *hashes, lists, *(pa.array(m, pa.int64()) for m in maps)], names=names)

    return map_batches(items.select("o", "content"), run, _HASHED, 1000)


_HASHED = f"o bigint, content_hash bigint, content_check bigint, words array<int>, {_MAPS}"


def run_rows(hashed: DataFrame) -> DataFrame:
    """(h, o, n_words, n_runs): one row per item and paragraph hash."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = b.column(1)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(offsets)
        codes = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint32).astype(np.uint64)
        row, h = paragraph_hashes(codes, offsets[:-1] - offsets[0], sizes)
        number = np.bincount(row, minlength=len(sizes))[row]
        cols = [pa.array(h, pa.int64()), b.column(0).take(pa.array(row, pa.int64())), pa.array(sizes[row], pa.int32()), pa.array(number, pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["h", "o", "n_words", "n_runs"])

    return map_batches(hashed.select("o", "words"), run, "h bigint, o bigint, n_words int, n_runs int", 1000)


def _listed(df: DataFrame, few: int = 200_000) -> DataFrame:
    """df, marked for broadcast where its checked number of rows allows it."""
    return F.broadcast(df) if df.count() <= few else df


def rarest_runs(rows: DataFrame, maps: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(h, o, n_words, old, s0, s1, s2, s3): of each item the paragraphs by which its near copies are looked for.

    rows: (h, o, n_words, n_runs, old, n), n being the number of items with h, at least 2; maps: the bitmap of each o. Items that share ``coverage`` of the
    paragraphs of the larger share one of the rarest of either: all but the last that many less one, in the
    order of (n, h) (prefix filter, exact).
    """
    least = F.greatest(F.ceil(F.col("n_runs") * coverage - 1e-9).cast("int"), F.lit(1))
    g = rows.groupBy("o").agg(F.first("n_words").alias("n_words"), F.first("n_runs").alias("n_runs"), F.first("old").alias("old"), F.sort_array(F.collect_list(F.struct("n", "h"))).alias("r"))
    g = g.where(F.size("r") >= least).select("o", "n_words", "old", F.slice(F.col("r.h"), F.lit(1), F.size("r") - least + 1).alias("hs"))
    return g.join(maps, "o").select(F.explode("hs").alias("h"), "o", "n_words", "old", *_MAP)


def _may_repeat(x: str, y: str, share: float) -> Column:
    """Whether x is before y, not both of the history, and their lengths allow a repeat (columns under prefixes)."""
    shorter, longer = F.least(f"{x}n_words", f"{y}n_words"), F.greatest(f"{x}n_words", f"{y}n_words")
    return (F.col(f"{x}o") < F.col(f"{y}o")) & ~(F.col(f"{x}old") & F.col(f"{y}old")) & (shorter >= longer * share - 1e-9)


def _maps_allow(x: str, y: str, share: float) -> Column:
    """_may_repeat, and by the bitmaps no fewer words of either than the share of the longer can stand in the other: true for all repeats."""
    least = F.ceil(F.greatest(f"{x}n_words", f"{y}n_words") * share - 1e-9)
    only = lambda p, q: sum((F.bit_count(F.col(f"{p}{m}").bitwiseAND(F.bitwise_not(f"{q}{m}"))) for m in _MAP), F.lit(0))
    return _may_repeat(x, y, share) & (only(x, y) <= F.col(f"{x}n_words") - least) & (only(y, x) <= F.col(f"{y}n_words") - least)


def _grouped_pairs(rows: DataFrame, share: float) -> DataFrame:
    """Distinct pairs (a, b) of each group h that lengths and bitmaps allow; the caller leaves only groups of at most BUCKET rows."""
    x, y = (rows.select("h", *(F.col(c).alias(f"{p}{c}") for c in ("o", "n_words", "old", *_MAP))) for p in ("x_", "y_"))
    return x.join(y, "h").where(_maps_allow("x_", "y_", share)).select(F.col("x_o").alias("a"), F.col("y_o").alias("b")).distinct()


def _hot(rows: DataFrame) -> DataFrame:
    """Groups h of more than BUCKET rows: at most one in BUCKET of all rows."""
    return stored(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET).select("h"), "hot-buckets")


def split_hot(rows: DataFrame, words: DataFrame, share: float) -> DataFrame:
    """The rows (h, o, n_words, old, s0, s1, s2, s3) of hot buckets split by rare words.

    Repeats share that part of all words, so they share one of the rarest of the rest (prefix filter): no repeat is lost.
    """
    own = words.select("o", "words").join(_listed(rows.select("o").distinct()), "o", "left_semi")
    # only the order of words by frequency comes from this bounded sample; any order gives the same repeats
    known = np.zeros(1 << 16, np.int64)
    for (sample,) in own.select(F.slice("words", 1, 1000)).limit(2000).collect():
        known[np.unique(np.array(sample, np.int32)) & 0xFFFF] += 1

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = []
        for ws in b.column(1).to_pylist():
            codes = np.array(ws, np.int32)
            distinct, n = np.unique(codes, return_counts=True)
            times = np.arange(len(codes)) - np.repeat(np.cumsum(n) - n, n)
            with np.errstate(over="ignore"):
                tokens = (np.repeat(distinct, n).astype(np.int64).view(np.uint64) + times.astype(np.uint64) * _MUL2) * _MUL
            often = np.repeat(known[distinct & 0xFFFF], n)
            first = len(codes) - int(np.ceil(share * len(codes) - 1e-9)) + 1
            lists.append(tokens[np.lexsort((tokens, often))[:first]].view(np.int64))
        offsets = pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32), pa.int32())
        rare = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists), pa.int64()))
        return pa.RecordBatch.from_arrays([b.column(0), rare], names=["o", "rare"])

    rare = map_batches(own, run, "o bigint, rare array<bigint>")
    split = rows.join(rare, "o").withColumn("w", F.explode("rare")).drop("rare")
    return stored(split.withColumn("h", F.xxhash64("h", "w")).drop("w"), "hot-groups")


def candidate_pairs(rare: DataFrame, words: DataFrame, share: float) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (a, b) of items that share one of their rarest paragraphs, and the rows of groups too hot for pairs, if any.

    rare: see rarest_runs. Hot buckets are split by rare words (split_hot); groups that are still
    too large come back and are resolved leader by leader (resolve_hot).
    """
    hot = _hot(rare)
    if hot.isEmpty():
        return _grouped_pairs(rare, share), None
    listed = _listed(hot)
    groups = split_hot(rare.join(listed, "h", "left_semi"), words, share)
    hotter = _listed(_hot(groups))
    pairs = _grouped_pairs(rare.join(listed, "h", "left_anti").unionByName(groups.join(hotter, "h", "left_anti")), share)
    return pairs, groups.join(hotter, "h", "left_semi").distinct()


def common_words(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit vectors of the shorter's length."""
    if len(a) > len(b):
        a, b = b, a
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        if m := where.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def is_repeat(a: list, b: list, share: float = 0.8) -> bool:
    """Whether at least that share of the words of the longer stand in the other in the same order."""
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    least = share * longer - 1e-9
    if not longer or shorter < least:
        return False
    x, y = set(a), set(b)
    if len(x - y) > len(a) - least or len(y - x) > len(b) - least:
        return False
    return common_words(a, b) >= least


def verified(pairs: DataFrame, words: DataFrame, share: float = 0.8) -> DataFrame:
    """The pairs (a, b) whose word sequences (o, words) are repeats."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("o")).distinct()
    w = words.select("o", "words").join(_listed(ids, 1_000_000), "o", "left_semi")
    side = lambda k: w.select(F.col("o").alias(k), F.col("words").alias(f"{k}_words"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_words", "b_words")
    # distinct words that the other lacks must not be more than may be missing: true for all repeats
    least = F.ceil(F.greatest(F.size("a_words"), F.size("b_words")) * share - 1e-9)
    lacks = lambda x, y: F.size(F.array_except(f"{x}_words", f"{y}_words")) <= F.size(f"{x}_words") - least
    both = both.where(lacks("a", "b") & lacks("b", "a"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        keep = [is_repeat(x, y, share) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both, run, "a bigint, b bigint", 1000)


def resolve_hot(hot: DataFrame, near: DataFrame, words: DataFrame, share: float = 0.8) -> DataFrame:
    """Verified pairs of hot groups without comparing everything with everything; near has the verified pairs from elsewhere.

    In rounds, the first items of each group (its leaders, 1, then 4, 16 and so on) are compared with all later ones and leave. A
    refused item leads no more, as nothing repeats it, but stays to be compared with other leaders, as it may repeat
    several accepted items. An item counts as refused only once an item it repeats is known to be accepted: one that no earlier
    item of its groups has yet to be compared with, and of which all items that it repeats are refused themselves.
    """
    left, edges, refused, n = hot, near.select("a", "b"), None, 1
    while True:
        free = left if refused is None else left.join(refused, "o", "left_anti")
        firsts = free.groupBy("h").agg(F.min("o").alias("first"))
        waiting = stored(free.select("h", "o").join(firsts, "h").where("o > first").select("o").distinct(), "hot-waiting")
        while True:
            known = edges
            if refused is not None:
                known = known.join(refused.withColumnRenamed("o", "a"), "a", "left_anti").join(refused.withColumnRenamed("o", "b"), "b", "left_anti")
            sure = known.join(known.select(F.col("b").alias("a")).distinct(), "a", "left_anti").join(waiting.withColumnRenamed("o", "a"), "a", "left_anti")
            more = stored(sure.select(F.col("b").alias("o")).distinct(), "hot-refused")
            if more.isEmpty():
                break
            refused = more if refused is None else refused.unionByName(more)
        free = left if refused is None else left.join(refused, "o", "left_anti")
        rank = F.row_number().over(Window.partitionBy("h").orderBy("o"))
        lead = stored(free.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank"), "hot-leaders")
        if lead.isEmpty():
            return edges
        x, y = (df.select("h", *(F.col(c).alias(p + c) for c in ["o", "old", "n_words", *_MAP])) for df, p in ((lead, "x_"), (left, "y_")))
        pairs = salted_join(y, x, "h", F.col("y_o"), "inner").where(_maps_allow("x_", "y_", share))
        pairs = stored(pairs.select(F.col("x_o").alias("a"), F.col("y_o").alias("b")).distinct().join(edges, ["a", "b"], "left_anti"), "hot-pairs")
        edges = edges.unionByName(stored(verified(pairs, words, share), "hot-found"))
        left, n = stored(left.join(lead.select("h", "o"), ["h", "o"], "left_anti"), "hot-left"), n * 4


def accepted_and_refused(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Goes through items in order: one that repeats an accepted item is refused, any other accepted.

    edges: (a, b) with a before b. Returns the edges from accepted to refused items and the refused items. Each round decides the items that no
    undecided earlier item is linked with, so there are as many rounds as the longest chain of repeats.
    """
    left, done = edges.select("a", "b"), []
    while not left.isEmpty():
        later = left.select(F.col("b").alias("a")).distinct()
        sure = left.join(later, "a", "left_anti")
        refused = stored(sure.select(F.col("b").alias("o")).distinct(), "refused")
        done.append(refused)
        rest = left.join(refused.withColumnRenamed("o", "b"), "b", "left_anti")
        left = stored(rest.join(refused.withColumnRenamed("o", "a"), "a", "left_anti").select("a", "b"), "undecided")
    out = reduce(DataFrame.unionByName, done) if done else edges.select(F.col("b").alias("o")).limit(0)
    links = edges.select("a", "b").join(out.withColumnRenamed("o", "a"), "a", "left_anti").join(out.withColumnRenamed("o", "b"), "b", "left_semi")
    return links.select("a", "b"), out


class HashHistory:
    """The history of accepted items: tables bucketed by hash, to which each admission appends a generation.

    ``contents`` (content_hash, content_check, o) is bucketed by content_hash, ``runs`` (h, o, n_words, n_runs) by h, ``files`` (sha, o) by sha;
    ``words`` (o, words) has the word sequences for verification, ``refused`` (b, a) the results. All are partitioned by
    generation, and only generations with a commit mark, which is created in one step, are read (a negative one holds an admission's runs until it
    is decided what is accepted): an admission that fails leaves nothing behind, and one that is repeated under its label returns its result again. The number of buckets is fixed at creation.
    """

    TABLES = {"contents": ("content_hash bigint, content_check bigint, o bigint", "content_hash"), "runs": ("h bigint, o bigint, n_words int, n_runs int", "h"), "files": ("sha string, o bigint", "sha")}

    def __init__(self, spark: SparkSession, path: str, n_buckets: int | None = None, share: float = 0.8, coverage: float = COVERAGE):
        self.spark, self.path, self.share, self.coverage = spark, path.rstrip("/"), share, coverage
        self.files = SharedFiles(spark)
        wanted = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        names = self.files.names(f"{self.path}/_buckets")
        if not names:
            self.files.mark(f"{self.path}/_buckets/{wanted}")
        self.n_buckets = int(names[0]) if names else wanted

    def _name(self, table: str) -> str:
        return f"pagemill_{table}_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    def _table(self, table: str) -> str:
        """The table's name, defined in this session over the files at the path."""
        columns, by = self.TABLES[table]
        name = self._name(table)
        self.spark.sql(f"create table if not exists {name} ({columns}, gen int) using parquet partitioned by (gen) clustered by ({by}) into {self.n_buckets} buckets location '{self.path}/{table}'")
        return name

    def generations(self) -> dict[int, str]:
        """Committed generations with their labels."""
        return dict((int(n.split("-")[0]), n.partition("-")[2]) for n in self.files.names(f"{self.path}/_commits"))

    def bucketed(self, table: str, gens: list[int]) -> DataFrame:
        return self.spark.table(self._table(table)).where(F.col("gen").isin(gens)).drop("gen")

    def _append(self, df: DataFrame, table: str, gen: int, in_place: bool = False) -> None:
        """Writes a generation, one file per bucket; rows that come out of the same buckets (in_place) aren't shuffled for it."""
        by = self.TABLES[table][1]
        df = df if in_place else df.repartition(self.n_buckets, by)
        df.withColumn("gen", F.lit(gen)).write.option("compression", "zstd").insertInto(self._table(table))
        self.spark.catalog.refreshTable(self._name(table))

    def _write(self, df: DataFrame, table: str, gen: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{table}/gen={gen}")

    def _plain(self, table: str, schema: str, gens: list[int]) -> DataFrame:
        paths = [f"{self.path}/{table}/gen={g}" for g in gens]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _begin(self, label: str | None) -> tuple[int, list[int], bool]:
        """Number of the next generation, the committed ones, and whether the label is among them; clears what a failed admission left."""
        done = self.generations()
        if label is not None and label in done.values():
            return next(g for g, x in done.items() if x == label), sorted(done), True
        gen = max(done, default=0) + 1
        for table in (*self.TABLES, "words", "refused"):
            self.files.remove(f"{self.path}/{table}/gen={gen}")
        self.files.remove(f"{self.path}/runs/gen={-gen}")
        return gen, sorted(done), False

    def _result(self, gens: list[int]) -> DataFrame:
        r = self._plain("refused", "b bigint, a bigint", gens)
        return r.select(key_of("b").alias("key"), batch_of("b").alias("batch_no"), key_of("a").alias("accepted_key"))

    def refused(self) -> DataFrame:
        """(key, batch_no, accepted_key) of all admissions."""
        return self._result(sorted(self.generations()))

    def admit_files(self, batch: DataFrame, label: str | None = None) -> DataFrame:
        """(key, batch_no, accepted_key) of the items of a batch (key, batch_no, sha) whose file was accepted before; appends the hashes of the others.

        Null hashes prove nothing, null keys have no row. Only the buckets of the hashes meet; a hash that a third of all items has is
        represented by its first item, and the join with the first items splits what is skewed (adaptive execution).
        """
        gen, gens, again = self._begin(label)
        if again:
            return self._result([gen])
        new = stored(batch.where("key is not null and sha is not null").select("sha", order_number(F.col("batch_no"), F.col("key")).alias("o")).distinct(), "batch-files")
        heads = new.groupBy("sha").agg(F.min("o").alias("head"), F.count(F.lit(1)).alias("n"))
        if gens:
            old = self.bucketed("files", gens).select("sha", F.col("o").alias("head"), F.lit(True).alias("old"))
            met = heads.select("sha").join(old, "sha")
            heads = heads.join(met, "sha", "left").select("sha", "n", F.coalesce(met["head"], heads["head"]).alias("head"), F.coalesce("old", F.lit(False)).alias("old"))
        else:
            heads = heads.withColumn("old", F.lit(False))
        heads = stored(heads, "batch-file-heads")
        found = new.join(_listed(heads.where("n > 1 or old")), "sha").where("o <> head")
        self._write(found.select(F.col("o").alias("b"), F.col("head").alias("a")), "refused", gen)
        self._append(heads.where("not old").select("sha", F.col("head").alias("o")), "files", gen)
        self.files.mark(f"{self.path}/_commits/{gen}-{label or ''}")
        return self._result([gen])

    def admit(self, batch: DataFrame, key: str, content: str, batch_col: str, label: str | None = None) -> DataFrame:
        """Refuses the items of one or several successive batches that repeat accepted ones and appends the hashes of the others.

        Items are taken in the order (batch, key), so that the outcome doesn't depend on how batches are put together. Returns (key, batch_no, accepted_key) of the refused.
        Each full copy is represented by the first item of its content, so copies are never compared with
        one another, however many there are. Null, empty and blank contents and those without a
        word repeat nothing; a null batch comes last; a null key has no row; repeated rows of a key count once; very long texts are
        compared whole; other columns are ignored; an empty batch gives an empty result.
        """
        gen, gens, again = self._begin(label)
        if again:
            return self._result([gen])
        items = batch.where(F.col(key).isNotNull()).select(order_number(F.col(batch_col), F.col(key)).alias("o"), F.col(content).alias("content"))
        self._write(hash_items(items), "words", gen)
        hashed = self._plain("words", _HASHED, [gen])
        words = self._plain("words", _HASHED, [*gens, gen])
        content_key = ["content_hash", "content_check"]
        groups = hashed.groupBy(*content_key).agg(F.min("o").alias("head"), F.max("o").alias("last"), F.count(F.lit(1)).alias("n"))
        if gens:
            groups = groups.join(self.bucketed("contents", gens).withColumnRenamed("o", "old"), content_key, "left")
        else:
            groups = groups.withColumn("old", F.lit(None).cast("bigint"))
        groups = stored(groups, "batch-contents")
        several = groups.where("n > 1 or old is not null").select("content_hash", F.col("content_check").alias("check"), "head", "old")
        # every row of a content that has several or lies in the history
        copies = hashed.select("o", *content_key).join(_listed(several), "content_hash").where("check = content_check")
        copies = stored(copies.select("o", "head", "old").distinct(), "batch-copies")
        heads = groups.where("old is null").select(*content_key, F.col("head").alias("o"))
        single = hashed.select("o", "words").join(_listed(copies.select("o").distinct()), "o", "left_anti")
        first = hashed.select("o", "words").join(_listed(copies.where("old is null and o = head").select("o").distinct()), "o", "left_semi").dropDuplicates(["o"])
        self._append(run_rows(single.unionByName(first)), "runs", -gen)
        rare = stored(rarest_runs(self._met(gen, gens), words.select("o", *_MAP), self.coverage), "batch-rare")
        pairs, hot = candidate_pairs(rare, words, self.share)
        near = stored(verified(stored(pairs, "batch-pairs"), words, self.share).distinct(), "batch-near")
        if hot is not None:
            hot = stored(hot, "batch-hot")
            near = near if hot.isEmpty() else stored(resolve_hot(hot, near, words, self.share).distinct(), "batch-edges")
        links, refused = accepted_and_refused(near)
        refused = stored(refused, "batch-refused")
        self._write(self._refusals(copies, near, links, refused), "refused", gen)
        listed = _listed(refused)
        self._append(heads.join(listed, "o", "left_anti").select(*content_key, "o"), "contents", gen)
        self._append(self.bucketed("runs", [-gen]).join(listed, "o", "left_anti").select("h", "o", "n_words", "n_runs"), "runs", gen, in_place=True)
        self.files.mark(f"{self.path}/_commits/{gen}-{label or ''}")
        self.files.remove(f"{self.path}/runs/gen={-gen}")
        return self._result([gen])

    def _met(self, gen: int, gens: list[int]) -> DataFrame:
        """(h, o, n_words, n_runs, old, n) of the new items' paragraphs that several items have, in the history or among the new, and of the history's rows with the same hashes.

        Bucket by bucket: nothing is shuffled.
        """
        both = self.spark.table(self._table("runs")).where(F.col("gen").isin(-gen, *gens)).withColumn("old", F.col("gen") > 0).drop("gen")
        w = Window.partitionBy("h")
        met = both.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("met", F.min("old").over(w))
        return met.where("n > 1 and not met").drop("met")

    def _refusals(self, copies: DataFrame, near: DataFrame, links: DataFrame, refused: DataFrame) -> DataFrame:
        """(b, a): every refused item with the accepted ones that it or the first item of its content repeats."""
        heads = links.select(F.col("b").alias("head"), F.col("a").alias("accepted"))
        # a refused first item may be like an accepted later one, which its copies after that repeat
        later = near.join(refused.withColumnRenamed("o", "a"), "a", "left_semi").join(refused.withColumnRenamed("o", "b"), "b", "left_anti")
        by_head = heads.unionByName(later.select(F.col("a").alias("head"), F.col("b").alias("accepted"))).groupBy("head").agg(F.collect_set("accepted").alias("all"))
        members = copies.where("old is null and o <> head").select("o", "head")
        found = members.join(_listed(by_head), "head", "left").select(F.col("o").alias("b"), F.explode(F.coalesce("all", F.array("head"))).alias("a")).where("a < b")
        full = copies.where("old is not null").select(F.col("o").alias("b"), F.col("old").alias("a"))
        return full.unionByName(found).unionByName(links.select("b", "a")).distinct()

    def drop(self) -> None:
        """Removes the tables and all files."""
        for table in self.TABLES:
            self.spark.sql(f"drop table if exists {self._name(table)}")
        self.files.remove(self.path)


def successive(items: DataFrame, batch: str, at_once: int) -> list[tuple[str, Column]]:
    """(label, condition) of each ``at_once`` successive batches; null batches come last. Batches are few, so their numbers go to the driver."""
    numbers = sorted((r[0] for r in items.select(batch).distinct().collect()), key=lambda n: (n is None, n))
    out = []
    for i in range(0, len(numbers), at_once):
        part = numbers[i : i + at_once]
        known = [n for n in part if n is not None]
        some = F.col(batch).between(known[0], known[-1]) if known else F.lit(False)
        out.append((f"{part[0]}..{part[-1]}", some | F.col(batch).isNull() if None in part else some))
    return out


def first_versions(records: DataFrame) -> DataFrame:
    """(key, batch_no, sha) by the first version of each record; null, blank, all-zero and malformed hashes and that of the empty file are null.

    Records without a doc_id have no row; repeated rows count once.
    """
    first = F.min_by(F.struct("batch_no", "sha256"), F.coalesce("version_no", F.lit(2147483647))).alias("v")
    r = records.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("key")).agg(first)
    return r.select("key", F.col("v.batch_no").alias("batch_no"), canonical_sha256(F.col("v.sha256")).alias("sha"))
