"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut at its own marks (line ends, and ends of sentences in any line) and the pieces are hashed to
64-bit digests. A sketch has three tables of cells; each digest adds itself to one cell of each: a
count, the XOR of the digests and the XOR of their check hashes. Sketches subtract cell by cell, so
what two versions share cancels. A cell left with one digest (count 1 or -1 and a fitting check) is
*pure*: the digest is recovered and taken out of its other cells, which makes more cells pure.

The fingerprint is the sketch of ``BASE`` cells per table as text. The likeness of two texts is that of their
fingerprints: these are subtracted and peeled, within the row, since their size is fixed. If cells
remain, more digests differ than so many cells can tell, and the pair is tried again with larger
sketches, sized by the counts that the fingerprints hold, then twice as large until it is solved. Those are
peeled as DataFrames: a cell is a row, subtraction is a grouped sum and XOR, and peeling one table is
an explode of its pure cells followed by the same aggregate. The recovered digests are the paragraphs
that differ, so the likeness is exact: shared paragraphs over all distinct paragraphs. Everything
runs on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.common import NO_ID, doc_key, staged_by, table

#: where a text is cut: line ends, and white space after the end of a sentence and up to three closing signs; the
#: marks of scripts without spaces cut where they stand
CUT = r"\n|(?=\s)(?<=[.!?][^\w\s]{0,3})\s+|(?<=[\u3002\uff01\uff1f\u0964\u06d4])"
TABLES = 3
BASE = 4                   # cells per table of the fingerprint
SPARE = 1.4                # cells per digest that may differ, at the first try
SLACK = 12                 # cells beyond that
STEPS = 9                  # tables peeled before the rest is written down
_CHECK = 7_777


def paragraphs(text: Column) -> Column:
    """Trimmed non-empty paragraphs of a text, in order. Where it is cut depends on the text beside the cut alone."""
    return F.filter(F.transform(F.split(text, CUT), lambda p: F.trim(p)), lambda p: p != "")


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def _place(key: Column, number: int, cells: Column, attempt: int = 0) -> Column:
    """Cell of ``key`` in table ``number``, counted through all tables."""
    return (F.pmod(F.xxhash64(key, F.lit(number + TABLES * attempt)), cells.cast("long")) + number * cells).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(_CHECK))


def placed(keys: Column) -> Column:
    """Every digest with its check and its cell in each table of a fingerprint."""
    return F.transform(keys, lambda k: F.struct(
        k.alias("k"), _check(k).alias("c"), F.array(*[_place(k, t, F.lit(BASE)) for t in range(TABLES)]).alias("at")))


def sketch(held: Column) -> Column:
    """``placed`` digests → the cells (n, k, c) of the fingerprint's tables, one after the other."""
    # (a lambda's second parameter would be the element's index, so loop values come in by closure)
    def xor(xs: Column, part: str) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x[part]))

    def cell(number: int, c: int) -> Column:
        mine = F.filter(held, lambda x: F.get(x["at"], F.lit(number)) == number * BASE + c)
        return F.struct(F.size(mine).cast("long").alias("n"), xor(mine, "k").alias("k"), xor(mine, "c").alias("c"))

    return F.array(*[cell(number, c) for number in range(TABLES) for c in range(BASE)])


def sketch_text(cells: Column) -> Column:
    """The fingerprint: ``count:xor of digests:xor of checks`` of every cell, in hexadecimal."""
    return F.lower(F.array_join(F.transform(cells, lambda x: F.concat_ws(":", F.hex(x["n"]), F.hex(x["k"]), F.hex(x["c"]))), ","))


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def peeled(a: Column, b: Column) -> Column:
    """Two fingerprints' cells → (only_a, only_b, solved): digests recovered from their difference, and whether no
    cell remains."""
    minus = lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c"))
    pure = lambda x: (F.abs(x["n"]) == 1) & (x["c"] == _check(x["k"]))

    def step(s: Column, _: Column) -> Column:
        def take(p: Column) -> Column:
            def out_of(at: Column) -> Column:
                cells = F.transform(s["cells"], lambda x, i: F.when(F.array_contains(at, i), minus(x, p)).otherwise(x))
                return F.struct(cells.alias("cells"), (s["a"] + (p["n"] > 0).cast("int")).alias("a"), (s["b"] + (p["n"] < 0).cast("int")).alias("b"))

            places = F.array(*[_place(p["k"], t, F.lit(BASE)) for t in range(TABLES)])
            return F.when(p.isNull(), s).otherwise(_bind(places, out_of))

        return _bind(F.get(F.filter(s["cells"], pure), F.lit(0)), take)

    start = F.struct(F.zip_with(a, b, minus).alias("cells"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TABLES * BASE)), start, step, lambda s: F.struct(
        s["a"].alias("only_a"), s["b"].alias("only_b"),
        (~F.exists(s["cells"], lambda x: (x["n"] != 0) | (x["k"] != 0) | (x["c"] != 0))).alias("solved")))


# ---- neighbours -------------------------------------------------------------------------------


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_next(docs: DataFrame, columns: list[str], derived: list[dict[str, Column]] | None = None) -> DataFrame:
    """``docs`` (_d, _h and ``columns``) plus ``next_<column>`` of the row next in (_d, _h), the first following the last.

    ``derived`` columns are made of ``columns``, and of those derived before them, where the rows have arrived: they do not travel.

    Rows go to buckets of the key at approximate quantiles of it: ids, and where one id fills several buckets the
    hashes of its rows. The first row of each bucket is also sent, as a guest, to the end of the bucket
    before it, so one shuffle finds every neighbour.
    """
    spark = docs.sparkSession
    buckets = 3 * _partitions(spark)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = docs.agg(F.percentile_approx("_d", shares, 20_000)).first()[0] or []
    bounds = [(d, -(1 << 63)) for d in sorted(set(cuts))]
    for d in sorted(d for d in set(cuts) if cuts.count(d) > 1):  # a hot id, or all rows without one
        n = cuts.count(d)
        hashes = docs.where(F.col("_d") == d).agg(F.percentile_approx("_h", [i / n for i in range(1, n)], 20_000)).first()[0]
        bounds += [(d, h) for h in sorted(set(hashes))]
    at = F.struct(F.col("_d").alias("d"), F.col("_h").alias("h"))
    edges = F.array(*[F.struct(F.lit(d).cast("long").alias("d"), F.lit(h).cast("long").alias("h")) for d, h in sorted(bounds)])
    bucket = F.size(F.filter(edges, lambda b: b <= at)) if bounds else F.lit(0)
    placed_ = docs.withColumn("_bucket", bucket)
    firsts = sorted((r["_bucket"], r.f["_d"], r.f["_h"]) for r in
                    placed_.groupBy("_bucket").agg(F.min(F.struct("_d", "_h")).alias("f")).collect())
    rows = [(b, d, h, firsts[i - 1][0]) for i, (b, d, h) in enumerate(firsts)]
    guests = spark.createDataFrame(rows, "_bucket int, _fd long, _fh long, _before int")
    first = (F.col("_d") == F.col("_fd")) & (F.col("_h") == F.col("_fh"))
    place = lambda b, guest: F.struct(F.col(b).alias("b"), F.lit(guest).alias("g"))
    sent = placed_.join(F.broadcast(guests), "_bucket").withColumn(  # one row per bucket
        "_to", F.explode(F.when(first, F.array(place("_bucket", False), place("_before", True)))
                         .otherwise(F.array(place("_bucket", False)))))
    sent = sent.select("_d", "_h", *columns, F.col("_to.b").alias("_bucket"), F.col("_to.g").alias("_guest"))
    sent = sent.repartition("_bucket")
    for more in derived or []:
        sent, columns = sent.withColumns(more), [*columns, *more]
    order = Window.partitionBy("_bucket").orderBy("_guest", "_d", "_h")
    return sent.select("*", F.row_number().over(order).alias("_row"),
                       *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where(~F.col("_guest")).drop("_guest")


# ---- difference by peeling --------------------------------------------------------------------


_GROUP = ["_id", "kind", "cells", "cell"]


def _summed(rows: DataFrame) -> DataFrame:
    """Cells of equal place added up; empty cells vanish."""
    return (rows.groupBy(*_GROUP).agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
            .where("cell < 0 OR n <> 0 OR k <> 0 OR c <> 0"))


def _pure() -> Column:
    return (F.col("cell") >= 0) & (F.abs("n") == 1) & (F.col("c") == _check(F.col("k")))


def _peel(cells: DataFrame, number: int, attempt: int) -> DataFrame:
    """Recover the digests of the pure cells of one table and take them out of the other tables.

    Recovered digests are counted in cell -1 (first text only) or -2 (second text only).
    """
    at = lambda cell, n, k, c: F.struct(cell.cast("int").alias("cell"), n.cast("long").alias("n"), k.alias("k"), c.alias("c"))
    n, k, c, size = F.col("n"), F.col("k"), F.col("c"), F.col("cells")
    zero = F.lit(0).cast("long")
    out = [at(_place(k, t, size, attempt), -n, k, c) for t in range(TABLES) if t != number]
    found = at(F.when(n > 0, -1).otherwise(-2), F.lit(1), zero, zero)
    mine = _pure() & (F.col("cell") == _place(k, number, size, attempt))
    return _summed(cells.select(*_GROUP[:-1], F.explode(F.when(mine, F.array(found, *out)).otherwise(
        F.array(at(F.col("cell"), n, k, c)))).alias("x")).select(*_GROUP[:-1], "x.*"))


def differences(pairs: DataFrame) -> DataFrame:
    """``pairs`` (_id, kind, a, b: digest arrays, dealt by _id) → (_id, kind, only_a, only_b), dealt alike.

    ``a`` and ``b`` hold distinct digests; the counts are of digests recovered by peeling, exact
    for every pair. All that is written down stays dealt by _id, so nothing is moved but the counts in the end.
    """
    key = ["_id", "kind"]
    dealt = _partitions(pairs.sparkSession)
    done, attempt, open_pairs = [], 1, pairs  # attempt 0 are the fingerprints themselves
    while True:
        size = F.ceil(((F.size("a") + F.size("b")) * SPARE + SLACK) * 2**(attempt - 1) / TABLES).cast("int")
        signed = F.concat(F.transform("a", lambda x: F.struct(x.alias("k"), F.lit(1).alias("n"))),
                          F.transform("b", lambda x: F.struct(x.alias("k"), F.lit(-1).alias("n"))))
        cells = (open_pairs.select(*key, size.alias("cells"), F.explode(signed).alias("s"))
                 .select(*key, "cells", F.col("s.k").alias("k"), F.col("s.n").cast("long").alias("n"), _check(F.col("s.k")).alias("c"),
                         F.explode(F.array(*[_place(F.col("s.k"), t, F.col("cells"), attempt) for t in range(TABLES)])).alias("cell")))
        cells = _summed(cells)
        counts = None
        while True:
            for step in range(STEPS):
                cells = _peel(cells, step % TABLES, attempt)
            cells = staged_by(cells, "peeled", "_id", dealt)
            got = cells.where("cell < 0").select(*key, "cell", "n")
            counts = got if counts is None else counts.union(got)
            cells = cells.where("cell >= 0")
            if cells.where(_pure()).isEmpty():
                break
        # by row, as a join by several columns would move both sides
        stuck = cells.groupBy("_id").agg(F.collect_set("kind").alias("stuck"))
        if stuck.isEmpty():
            done.append(counts)
            break
        is_stuck = F.array_contains("stuck", F.col("kind"))
        done.append(counts.join(stuck, "_id", "left").where(F.col("stuck").isNull() | ~is_stuck).drop("stuck"))
        failed = staged_by(open_pairs.join(stuck, "_id").where(is_stuck).drop("stuck"), "retry", "_id", dealt)
        attempt, open_pairs = attempt + 1, failed
    total = done[0]
    for more in done[1:]:
        total = total.union(more)
    only = lambda cell: F.sum(F.when(F.col("cell") == cell, F.col("n")).otherwise(0))
    return total.repartition(dealt, "_id").groupBy(*key).agg(only(-1).alias("only_a"), only(-2).alias("only_b"))


def likeness(size_a: Column, only_a: Column, only_b: Column) -> Column:
    """Shared digests over all distinct digests of both texts; 1 if neither has any."""
    union = size_a + only_b
    return F.when(union == 0, 1.0).otherwise((size_a - only_a) / union)


# ---- operator ---------------------------------------------------------------------------------


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of the
    next document (ascending doc_id; rows of one id by their text's hash, rows without an id last;
    the first follows the last). Null texts count as empty. Other columns of ``docs`` are not read.
    """
    rows = docs.select(doc_key().alias("_d"), F.coalesce("text", F.lit("")).alias("text")).select(
        "_d", F.xxhash64("text").alias("_h"), "text")
    both = with_next(rows, ["text"], [{"keys": digests(F.col("text"))}, {"_held": placed(F.col("keys"))}, {"_keys": sketch(F.col("_held"))}])
    both = both.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("half", (F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.expr("left(text, cast(n_chars - half AS int))"), F.expr("left(next_text, half)"))
    kinds = {0: "edited_keys", 1: "next_keys"}
    row = F.shiftleft(F.col("_bucket").cast("long"), 32) + F.col("_row")
    both = both.select(row.alias("_id"), "_d", "n_chars", "keys", "next_keys", "_keys", F.col("next__keys").alias("_next_keys"), edited.alias("edited"))
    kept = both.select(*both.drop("edited").columns, F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("edited")).alias("edited_keys"))
    named = ["_id", "_d", "n_chars", "edited_sha256", "keys", *kinds.values()]
    cells = kept.select("*", placed(F.col("edited_keys")).alias("_held")).select("*", sketch(F.col("_held")).alias("_edited_keys"))
    # a cell gives one digest at most: sizes further apart than there are cells cannot be solved
    far = F.struct(F.lit(0).alias("only_a"), F.lit(0).alias("only_b"), F.lit(False).alias("solved"))
    solve = lambda k: F.when(F.abs(F.size("keys") - F.size(k)) > TABLES * BASE, far).otherwise(
        peeled(F.col("_keys"), F.col(f"_{k}")))
    # dealt out once, by row: all below reads it where it lies
    parts = _partitions(docs.sparkSession)
    kept = cells.select(*named, *[solve(k).alias(f"first_{n}") for n, k in kinds.items()]).repartition(parts, "_id")
    kept = staged_by(kept, "paragraph-digests", "_id", parts)
    pair = lambda n: F.when(~F.col(f"first_{n}.solved"), F.struct(F.lit(n).alias("kind"), F.col("keys").alias("a"), F.col(kinds[n]).alias("b")))
    unsolved = kept.where(~(F.col("first_0.solved") & F.col("first_1.solved")))
    pairs = unsolved.select("_id", F.explode(F.array_compact(F.array(*map(pair, kinds)))).alias("p")).select("_id", "p.*")
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    diff = differences(pairs).groupBy("_id").agg(
        *[of(kind, c).alias(f"{c}_{kind}") for kind in kinds for c in ("only_a", "only_b")])
    # (equal digests leave no cell, but those are solved at first)
    count = lambda c, n: F.when(F.col(f"first_{n}.solved"), F.col(f"first_{n}.{c}")).otherwise(F.coalesce(F.col(f"{c}_{n}"), F.lit(0)))
    size = F.size("keys")
    out = kept.join(diff, "_id", "left").select(
        F.when(F.col("_d") < NO_ID, F.col("_d")).alias("doc_id"), "n_chars", "edited_sha256",
        likeness(size, count("only_a", 0), count("only_b", 0)).alias("near_edited"),
        likeness(size, count("only_a", 1), count("only_b", 1)).alias("near_next"),
        placed(F.col("keys")).alias("_a"), placed(F.col("edited_keys")).alias("_b"))
    return out.select("doc_id", "n_chars", "edited_sha256", sketch_text(sketch(F.col("_a"))).alias("fingerprint"),
                      sketch_text(sketch(F.col("_b"))).alias("edited_fingerprint"), "near_edited", "near_next")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
