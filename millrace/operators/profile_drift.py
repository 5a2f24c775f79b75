"""Profiles of every column, nested ones too, from maintained value counts, and the loads in which a column changes.

A record is taken apart into one entry for each value of each column. What is kept is a value-count table: how
often each value of each column came in each load. Counts are signed, so a load is added or taken back by adding
its delta. Exact metrics - nulls, distinct values, range, mean, entropy - and the histograms that loads are
compared by are derived from the counts, never from the records again.

A value is kept as it is, its text or its number, with a 64-bit hash by which it is looked up. Every load has a signed delta of its
own, and the table stays in its folder, so that a later session goes on from it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import Workspace, numbered, remove
from .skew import short

_ENTRY = "array<struct<c:int,t:string,x:double>>"
_COUNTS = ["load_id", "c", "key", "t", "x", "n"]
_COUNT_SCHEMA = "load_id string, c int, key bigint, t string, x double, n bigint"
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Limits:
    """When two loads differ: by how much at least, and how surely.

    ``share``: difference of the share of nulls, of one value or of the most frequent one, a thirtieth at least; ``form``: total
    variation of formats; ``curve``: greatest distance of two cumulative distributions, which must be surer if it is ``slight``. The
    ``z`` are multiples of what chance explains. A difference must also be ``usual`` times the median of those between
    all loads of its column, and for formats, which go by records where they are nested, its ``z`` likewise.
    """

    share: float = 0.08
    share_z: float = 4.0
    null_z: float = 5.0
    form: float = 0.15
    form_z: float = 4.0
    curve: float = 0.2
    curve_z: float = 2.5
    slight: float = 0.08
    slight_z: float = 4.0
    usual: float = 4.0

    def __post_init__(self) -> None:
        if self.share < 1 / 30:
            raise ValueError("single values are looked at from a thirtieth of a load on")


def _joined(arrays: Column) -> Column:
    """The arrays put together; null ones hold nothing."""
    return F.flatten(F.filter(arrays, lambda a: a.isNotNull()))


def _entries(schema: T.StructType, skip: set[str]) -> tuple[list[str], list[Column]]:
    """The columns' names and, for each, the array of its entries in one record."""
    names: list[str] = []
    arrays: list[Column] = []

    def number(name: str) -> int:
        if name not in names:
            names.append(name)
        return names.index(name)

    def entry(name: str, c: Column, kind: T.DataType) -> Column:
        i = F.lit(number(name)).alias("c")
        if isinstance(kind, T.NumericType):
            return F.struct(i, F.lit(None).cast("string").alias("t"), c.cast("double").alias("x"))
        if isinstance(kind, (T.ArrayType, T.MapType)):
            return F.struct(i, F.lit(None).cast("string").alias("t"), F.when(c.isNotNull(), F.size(c)).cast("double").alias("x"))
        text = F.when(c.isNotNull(), F.lit("")) if isinstance(kind, T.StructType) else c.cast("string")
        return F.struct(i, text.alias("t"), F.lit(None).cast("double").alias("x"))

    def walk(name: str, kind: T.DataType, each) -> None:
        """``each(f)`` is the array that ``f`` makes of every value found at ``name``."""
        arrays.append(each(lambda v: F.array(entry(name, v, kind))))
        if isinstance(kind, T.StructType):
            for f in kind:
                walk(f"{name}.{f.name}", f.dataType, lambda g, f=f: each(lambda v: g(v[f.name])))
        elif isinstance(kind, T.MapType):
            walk(f"{name}.key", kind.keyType, lambda g: each(lambda v: _joined(F.transform(F.map_keys(v), g))))
            inside(name, kind.valueType, lambda g: each(lambda v: _joined(F.transform(F.map_values(v), g))))
        elif isinstance(kind, T.ArrayType):
            inside(name, kind.elementType, lambda g: each(lambda v: _joined(F.transform(v, g))))

    def inside(name: str, kind: T.DataType, each) -> None:
        if isinstance(kind, T.StructType):
            for f in kind:
                walk(f"{name}.{f.name}", f.dataType, lambda g, f=f: each(lambda v: g(v[f.name])))
        else:
            walk(f"{name}[]", kind, each)

    for f in schema:
        if f.name not in skip:
            walk(f.name, f.dataType, lambda g, f=f: g(F.col(f.name)))
    return names, arrays


def value_counts(df: DataFrame, load: str = "load_id", skip: tuple[str, ...] = ("load_id", "loaded_at")) -> tuple[DataFrame, list[str]]:
    """The delta of ``df``: ``load_id, c, key, t, x, n``, and the names of the columns that ``c`` numbers.

    One row for each value of each column in each load. ``t`` is a text, ``x`` a number. ``key`` is null for a null
    value; of an array or a map the value is its size, its parts are columns of their own: ``a.b`` for fields,
    ``a[]`` for elements, ``a.key`` for keys.
    """
    names, arrays = _entries(df.schema, set(skip))
    flat = df.select(F.col(load).alias("load_id"), F.inline(F.concat(*(F.coalesce(a, F.array().cast(_ENTRY)) for a in arrays))))
    key = F.when(F.col("t").isNotNull(), F.xxhash64("t")).when(F.col("x").isNotNull(), F.xxhash64("x"))
    flat = flat.withColumn("load_id", F.col("load_id").cast("string"))
    rows = flat.groupBy("load_id", "c", "t", "x").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("load_id", "c", key.alias("key"), "t", "x", "n"), names


class ValueCounts:
    """A value-count table kept in a folder all executors share; ``apply`` adds the delta of each load, ``take_back`` takes a load's away.

    Files are sorted by load, so a load is read or taken back without most of the others' rows. Deltas lie as they came
    until ``compact`` sums them up and drops values whose count is nought. Applying the same rows with sign 1 and -1 leaves
    the table as it was. Without ``path`` the table goes when the driver ends; with it, it can be opened again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.work = Workspace(spark, "value-counts")
        self.path = (path or f"{self.work.path}/store").rstrip("/")
        held = numbered(spark, f"{self.path}/names")
        self.names: list[str] | None = [r.name for r in spark.read.parquet(f"{self.path}/names/{held[-1]}").orderBy("c").collect()] if held else None  # one row for each column

    def _deltas(self) -> list[int]:
        return numbered(self.spark, f"{self.path}/deltas")

    def _add(self, delta: DataFrame) -> None:
        """Write the signed deltas of some loads; they are where their values were counted, so nothing is shuffled again."""
        number = max(self._deltas(), default=-1) + 1
        delta.select(*_COUNTS).sortWithinPartitions("load_id").write.parquet(f"{self.path}/deltas/{number}")

    def apply(self, df: DataFrame, sign: int = 1, load: str = "load_id", skip: tuple[str, ...] = ("load_id", "loaded_at")) -> None:
        """Add the deltas of all loads in ``df``, in one pass."""
        delta, names = value_counts(df, load, skip)
        if self.names is None:
            rows = self.spark.createDataFrame(list(enumerate(names)), "c int, name string")
            rows.coalesce(1).write.parquet(f"{self.path}/names/0")
            self.names = names
        elif names != self.names:
            raise ValueError("the columns are not those of the loads before")
        self._add(delta.withColumn("n", F.col("n") * sign) if sign != 1 else delta)

    def take_back(self, load_id: str) -> None:
        """Take all of a load away, from what is kept of it; its records are not needed, nor other loads read."""
        self._add(self.read(load_id).withColumn("n", -F.col("n")))

    def read(self, *loads: str) -> DataFrame:
        """The counts, of all loads or of some: a single delta as it is, more summed up."""
        tables = [self.spark.read.schema(_COUNT_SCHEMA).parquet(f"{self.path}/deltas/{k}") for k in self._deltas()]
        if loads:
            tables = [t.where(F.col("load_id").isin(*loads)) for t in tables]
        if not tables:
            return self.spark.createDataFrame([], _COUNT_SCHEMA)
        whole = reduce(DataFrame.unionByName, tables)
        if len(tables) > 1:
            whole = whole.groupBy("load_id", "c", "key", "t", "x").agg(F.sum("n").alias("n")).where("n <> 0")
        return whole

    def compact(self) -> None:
        """Sum up all deltas into one; readers that opened the old ones must open the table again."""
        old = self._deltas()
        if len(old) > 1:
            self._add(self.read())
            for k in old:
                remove(self.spark, f"{self.path}/deltas/{k}")


def _classes(t: Column) -> Column:
    """The format of a whole text: each run of letters and digits as ``x``, of white space as a blank, each other character once a run; repeated words are one."""
    plain = F.regexp_replace(F.regexp_replace(t, r"[\p{L}\p{M}\p{N}]+", "x"), r"\s+", " ")
    return F.regexp_replace(F.regexp_replace(plain, r"(.)\1+", "$1"), r"(\S+ )\1+", "$1")


def _malformed(counts: DataFrame) -> DataFrame:
    """``c, format, odd``: whether a format of a text column is none of its usual ones.

    Usual is what at least a hundredth of the texts of the column have, over all loads; a column less than nine tenths of
    which have a usual format, such as one of free text, has none, and no row here.
    """
    share = F.col("m") / F.sum("m").over(W.partitionBy("c"))
    odd = counts.where("t is not null").groupBy("c", _classes(F.col("t")).alias("format")).agg(F.sum("n").alias("m"))
    odd = odd.withColumn("odd", share < 0.01)
    usual = F.sum(F.when(~F.col("odd"), F.col("m"))).over(W.partitionBy("c")) / F.sum("m").over(W.partitionBy("c"))
    return odd.withColumn("usual", usual).where("usual >= 0.9").select("c", "format", "odd")


def metrics(counts: DataFrame, names: list[str], per_load: bool = True, patterns: dict[str, str] | None = None) -> DataFrame:
    """Exact metrics of each column, per load or over all.

    ``column_name, values, nulls, distinct, least, greatest, mean, entropy, least_text, greatest_text, malformed``: ``values``
    includes nulls; ``least``, ``greatest`` and ``mean`` are of numbers, sizes of arrays and maps, ``least_text`` and
    ``greatest_text`` of texts by their bytes; ``entropy`` in bits over the non-null values, 0 where there are none.
    ``malformed`` counts texts whose format is none of the usual ones of their column over all of ``counts``; it is null
    for columns that have no usual format and for those without texts. With ``patterns``, from column to regular expression, it
    counts instead the texts in which nothing matches that of their column, and is null for columns without one.
    """
    by = ["load_id", "c"] if per_load else ["c"]
    if patterns is None:
        formats = _malformed(counts)
        odd = counts.where("t is not null").groupBy(*by, _classes(F.col("t")).alias("format")).agg(F.sum("n").alias("n"))
        odd = odd.join(formats, ["c", "format"]).groupBy(*by).agg(F.sum(F.when(F.col("odd"), F.col("n")).otherwise(0)).alias("malformed"))
    else:
        fits = F.lit(None).cast("boolean")
        for name, pattern in patterns.items():
            fits = F.when(F.col("c") == names.index(name), F.col("t").rlike(pattern)).otherwise(fits)
        odd = counts.where("t is not null").where(F.col("c").isin([names.index(n) for n in patterns]))
        odd = odd.groupBy(*by).agg(F.sum(F.when(~fits, F.col("n")).otherwise(0)).alias("malformed"))
    if not per_load:
        counts = counts.groupBy("c", "key", "t", "x").agg(F.sum("n").alias("n"))
    some = F.col("key").isNotNull()
    there = F.when(some, F.col("n"))
    m = counts.groupBy(*by).agg(
        F.sum("n").alias("values"), F.coalesce(F.sum(F.when(~some, F.col("n"))), F.lit(0)).alias("nulls"), F.count(there).alias("distinct"),
        F.min("x").alias("least"), F.max("x").alias("greatest"), (F.sum(F.col("x") * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n")))).alias("mean"),
        F.sum(there * F.log2(there)).alias("nlogn"), F.sum(there).alias("some"), F.min("t").alias("least_text"), F.max("t").alias("greatest_text"),
    )
    # of a null load, too
    pair = [m[k].eqNullSafe(odd[k]) for k in by]
    m = m.join(odd, pair, "left").select(*(m[k] for k in m.columns), "malformed")
    entropy = F.coalesce(F.log2("some") - F.col("nlogn") / F.col("some"), F.lit(0.0))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("c") + 1)
    return m.select(
        *(["load_id"] if per_load else []), name.alias("column_name"), "values", "nulls", "distinct", "least", "greatest", "mean",
        F.abs(F.round(entropy, 9)).alias("entropy"), "least_text", "greatest_text", "malformed",
    )


#: Keeps numbers of bins above nought, so that they sort as texts.
_SHIFT = 5000


def _number_bin(x: Column) -> Column:
    """A whole number that rises with ``x``: 16 steps for each doubling, the same beyond 2**60 and below 2**-20.

    By it the values of a column and load are summed up in parts; distributions are compared at the values themselves.
    """
    size = F.log2(F.greatest(F.least(F.abs(x), F.lit(2.0**60)), F.lit(2.0**-20))) + 21
    step = F.floor(size * 16).cast("bigint")
    return F.when(x == 0, 0).when(x > 0, step).otherwise(-step)


def _runs(t: Column) -> Column:
    """The whole text with small letters as ``a``, capitals as ``A``, digits as ``9``, runs taken together."""
    plain = F.translate(t, _LOWER + _UPPER, "a" * 26 + "9" * 10 + "A" * 26)
    return F.regexp_replace(F.regexp_replace(plain, r"\s", " "), r"(.)\1+", "$1")


def _format(runs: Column) -> Column:
    """Runs with repeated words taken together; where letters and digits alternate, as in hashes, they are one ``x``, else hardly two values would be alike."""
    plain = F.regexp_replace(runs, r"(?<![aA9])[aA9]*?(?:[aA]9|9[aA])[aA9]*", "x")
    return F.regexp_replace(plain, r"(?<!\S)(\S+ )\1+", "$1")


def _kinds(runs: Column) -> Column:
    """Which kinds of characters there are: small letters, capitals, digits, and each other character."""
    letters = F.concat(*(F.when(F.contains(runs, F.lit(k)), k).otherwise("") for k in "aA9"))
    return F.concat(letters, F.array_join(F.array_sort(F.array_distinct(F.split(F.translate(runs, "aA9", ""), ""))), ""))


def _histograms(counts: DataFrame) -> DataFrame:
    """``load_id, c, what, bin, n``: histograms of nulls, forms, lengths, numbers.

    Of texts there are ``format``, what they are as a whole, ``classes``, the kinds of characters in them, and the exact
    length. Formats of free texts are hardly ever alike; there the others tell.
    """
    null = F.col("key").isNull()
    counts = counts.withColumn("runs", _runs(F.col("t"))).withColumn("format", _format(F.col("runs")))
    bins = {
        "null": F.when(null, "1").otherwise("0"),
        "format": F.when(F.length("format") > 48, F.xxhash64("format").cast("string")).otherwise(F.col("format")),
        "classes": _kinds(F.col("runs")),
        "length": F.lpad(F.length("t").cast("string"), 10, "0"),
        "number": F.when(F.col("x").isNotNull(), F.lpad((_number_bin(F.col("x")) + _SHIFT).cast("string"), 5, "0")),
    }
    pieces = F.array(*(F.struct(F.lit(w).alias("what"), b.alias("bin")) for w, b in bins.items()))
    return counts.select("load_id", "c", "n", F.inline(pieces)).where("bin is not null").groupBy("load_id", "c", "what", "bin").agg(F.sum("n").alias("n"))


def _beside(h: DataFrame, following: DataFrame, by: list[str]) -> DataFrame:
    """Each load's counts ``b`` beside those ``a`` of the load before it; ``following`` has ``load_id, next``."""
    both = h.join(following, "load_id", "left")
    zero = F.lit(0).cast("bigint")
    sides = F.array(F.struct(F.col("load_id"), zero.alias("a"), F.col("n").alias("b")), F.struct(F.col("next").alias("load_id"), F.col("n").alias("a"), zero.alias("b")))
    sides = both.select(*by, F.inline(F.when(F.col("next").isNull(), F.slice(sides, 1, 1)).otherwise(sides)))
    return sides.groupBy("load_id", *by).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _tests(work: Workspace, counts: DataFrame, following: DataFrame) -> DataFrame:
    """``load_id, c, test, effect, z`` for every load but the first.

    The counts are read four times - for histograms, numbers, frequent values and their counts in the loads beside - and each result,
    bounded for a column and load, is a table; so plans stay small, too.
    """
    h = work.write(_histograms(counts), "histograms")
    pairs = _beside(h, following, ["c", "what", "bin"])
    total = W.partitionBy("load_id", "c", "what")
    pairs = pairs.withColumn("na", F.sum("a").over(total)).withColumn("nb", F.sum("b").over(total)).where("na > 0 and nb > 0")
    pairs = work.write(pairs, "pairs")
    pa, pb = F.col("a") / F.col("na"), F.col("b") / F.col("nb")
    p = (F.col("a") + F.col("b")) / (F.col("na") + F.col("nb"))
    spread = F.sqrt(p * (1 - p) * (1 / F.col("na") + 1 / F.col("nb")))
    # total variation of forms and of nulls, beside what chance explains
    tv = pairs.where("what in ('format', 'classes', 'null')").groupBy("load_id", "c", "what").agg(F.sum(F.abs(pa - pb) / 2).alias("effect"), F.sum(spread * 0.3989).alias("chance"))
    tv = tv.select("load_id", "c", F.col("what").alias("test"), "effect", F.when(F.col("effect") > 0, F.col("effect") / F.greatest("chance", F.lit(1e-9))).otherwise(0.0).alias("z"))
    # greatest distance of the cumulative distributions of lengths and numbers, of these at every value that occurs
    upto = W.partitionBy("load_id", "c", "what").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    curve = pairs.where("what in ('number', 'length')").withColumn("ua", F.sum("a").over(upto)).withColumn("ub", F.sum("b").over(upto))
    within = W.partitionBy("load_id", "c", "bin").orderBy("x").rowsBetween(W.unboundedPreceding, 0)
    inside = _beside(counts.where("x is not null").select("load_id", "c", _number_bin(F.col("x")).alias("bin"), "x", "n"), following, ["c", "bin", "x"])
    inside = inside.select("load_id", "c", "bin", F.sum("a").over(within).alias("wa"), F.sum("b").over(within).alias("wb"))
    below = curve.where("what = 'number'").select("load_id", "c", (F.col("bin").cast("bigint") - _SHIFT).alias("bin"), (F.col("ua") - F.col("a")).alias("fa"), (F.col("ub") - F.col("b")).alias("fb"), "na", "nb")
    distance = lambda a, b: F.abs(a / F.col("na") - b / F.col("nb")).alias("d")
    numbers = inside.join(below, ["load_id", "c", "bin"]).select("load_id", "c", F.lit("number").alias("what"), distance(F.col("fa") + F.col("wa"), F.col("fb") + F.col("wb")), "na", "nb")
    curve = curve.where("what = 'length'").select("load_id", "c", "what", distance(F.col("ua"), F.col("ub")), "na", "nb").unionByName(numbers)
    curve = work.write(curve.groupBy("load_id", "c", "what").agg(F.max("d").alias("effect"), F.first("na").alias("na"), F.first("nb").alias("nb")), "curves")
    curve = curve.select("load_id", "c", F.col("what").alias("test"), "effect", (F.col("effect") * F.sqrt(F.col("na") * F.col("nb") / (F.col("na") + F.col("nb")))).alias("z"))
    # shares of single values: those that make up a thirtieth of a load, so at most thirty for a column and load; a difference of
    # shares that counts is larger than that, so no value without it in either load could make one (see Limits)
    sums = h.where("what = 'null'").groupBy("load_id", "c").agg(F.sum("n").alias("whole"))
    large = counts.where("key is not null").groupBy("load_id", "c", "key").agg(F.sum("n").alias("n")).join(sums, ["load_id", "c"]).where("n * 30 >= whole")
    large = work.write(large.select("load_id", "c", "key"), "frequent")
    # looked up in its own load, in the one before and in the one after
    near = following.select("load_id", "next")
    prior = following.select(F.col("next").alias("load_id"), F.col("load_id").alias("prior")).where("load_id is not null")
    keys = large.join(near, "load_id").join(prior, "load_id", "left").select(F.explode(F.array("load_id", "next", "prior")).alias("load_id"), "c", "key")
    keys = keys.where("load_id is not null").distinct()
    held = work.write(counts.where("key is not null").join(keys, ["load_id", "c", "key"]).groupBy("load_id", "c", "key").agg(F.sum("n").alias("n")), "held")
    shares = _beside(held, following, ["c", "key"])
    wholes = _beside(sums.withColumnRenamed("whole", "n"), following, ["c"]).select("load_id", "c", F.col("a").alias("na"), F.col("b").alias("nb")).where("na > 0 and nb > 0")
    several = held.groupBy("c", "key").agg(F.count(F.lit(1)).alias("loads")).where("loads > 1").select("c", "key")
    apart = F.abs(pa - pb)
    shares = shares.join(wholes, ["load_id", "c"]).join(several.withColumn("several", F.lit(True)), ["c", "key"], "left")
    # a value that one of the two loads lacks is a test of its own, with what is usual of such values; a column's loads may have values of their own
    kinds = F.array(F.when(F.col("several"), F.lit("value")), F.when((F.col("a") == 0) | (F.col("b") == 0), F.lit("fresh")))
    shares = shares.select("load_id", "c", F.explode(kinds).alias("test"), apart.alias("effect"), (apart / F.greatest(spread, F.lit(1e-9))).alias("z")).where("test is not null")
    top = shares.groupBy("load_id", "c", "test").agg(F.max(F.struct("effect", "z")).alias("m")).select("load_id", "c", "test", F.col("m.effect").alias("effect"), F.col("m.z").alias("z"))
    # the share of the most frequent value, whichever it is
    most = sums.join(held.groupBy("load_id", "c").agg(F.max("n").alias("n")), ["load_id", "c"], "left").select("load_id", "c", F.coalesce("n", F.lit(0)).alias("n"))
    most = _beside(most, following, ["c"]).join(wholes, ["load_id", "c"])
    most = most.select("load_id", "c", F.lit("most").alias("test"), apart.alias("effect"), (apart / F.greatest(spread, F.lit(1e-9))).alias("z"))
    top = top.unionByName(most)
    first = following.select(F.col("next").alias("load_id")).where("load_id is not null")
    return tv.unionByName(curve).unionByName(top).join(first, "load_id", "left_semi")


def loads_in_order(df: DataFrame) -> DataFrame:
    """``load_id, next``: each load with the one after it by ``loaded_at``, ties by id.

    Order is found within days and then among days, so that no task takes all loads.
    """
    at = df.where("load_id is not null").groupBy(F.col("load_id").cast("string").alias("load_id")).agg(F.min("loaded_at").alias("at")).withColumn("day", F.to_date("at"))
    at = at.withColumn("within", F.lead("load_id").over(W.partitionBy("day").orderBy("at", "load_id")))
    days = at.groupBy("day").agg(F.min_by("load_id", F.struct("at", "load_id")).alias("first"))
    # a row for each day that has a load
    days = days.select("day", F.lead("first").over(W.orderBy("day")).alias("after"))
    joined = at.join(days, at["day"].eqNullSafe(days["day"]))
    return joined.select("load_id", F.coalesce("within", "after").alias("next"))


def changed_columns(
    spark: SparkSession, store: ValueCounts, following: DataFrame, moving: tuple[str, ...] = (), limits: Limits = Limits()
) -> DataFrame:
    """``column_name, load_id, test, effect, z``: where a column's nulls, values, range, format or distribution are not those of the load before.

    ``moving`` are columns that move on in time by themselves; of these only nulls, format and length count.
    """
    names = store.names or []
    following = short(store.work.write(following, "loads"))
    tests = store.work.write(_tests(store.work, store.read(), following), "tests")
    # a load without a test differs by nought; the median is over all loads
    hundred = F.array(*(F.lit(i / 100) for i in range(101)))
    steps = [F.percentile("effect", hundred).alias("steps"), F.percentile("z", hundred).alias("z_steps")]
    usual = tests.groupBy("c", "test").agg(*steps, F.count(F.lit(1)).alias("tested")).join(F.broadcast(following.agg((F.count(F.lit(1)) - 1).alias("loads"))))
    at = F.round(100 * (1 - F.col("loads") / (2 * F.col("tested")))).cast("int") + 1
    middle = lambda of: F.when(at >= 1, F.element_at(of, at)).otherwise(0.0)
    usual = usual.select("c", "test", middle("steps").alias("median"), middle("z_steps").alias("median_z"))
    beyond = lambda least, z: (F.col("effect") >= least) & (F.col("z") >= z)
    differs = (
        F.when(F.col("test").isin("value", "fresh", "most"), beyond(limits.share, limits.share_z))
        .when(F.col("test") == "null", beyond(limits.share, limits.null_z))
        .when(F.col("test").isin("format", "classes"), beyond(limits.form, limits.form_z) & (F.col("z") >= limits.usual * F.col("median_z")))
        .otherwise(beyond(limits.curve, limits.curve_z) | beyond(limits.slight, limits.slight_z))
    )
    tests = tests.join(usual, ["c", "test"]).where(differs & (F.col("effect") >= limits.usual * F.col("median")))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("c") + 1)
    found = tests.select(name.alias("column_name"), "load_id", "test", "effect", "z")
    return found.where(~(F.col("column_name").isin(*moving) & F.col("test").isin("number", "value", "fresh", "most"))) if moving else found
