"""Order MinHash fingerprints with DataFrame functions only.

A text is a sequence of symbols: runs of up to twelve letters and digits, and single
other characters.  Its k-mers are numbered by occurrence, so repeats count.  Hashes
deal the numbered k-mers into bins; from each bin on the smallest few are selected, put
back into text order, and hashed together.  Two texts share a bin's hash if they
share its k-mers in the same order, so the share of equal bins falls with the edits
between them.

Everything happens within a row, in arrays of long numbers that hold a hash above a
position; sorting such an array groups equal hashes and keeps the order of the text.
A bin of too few k-mers goes on with those of the bins that follow it, the first after
the last: the bins are starts on one circle of hashes, and every tuple has an order if
the text has two k-mers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Symbols in a k-mer, bins of a fingerprint, k-mers selected in each bin.
K = 3
BINS = 64
SELECTED = 2
#: The lower bits of a packed number hold a position among the symbols; the bits
#: between them and the sign hold a hash, of which the upper six name the bin.
PLACE_BITS = 28
HASH_BITS = 63 - PLACE_BITS
BIN_SHIFT = 63 - 6
#: Runs of letters and digits below U+2E80, or any other single character.
SYMBOL = r"[\p{L}\p{M}\p{N}&&[^\x{2E80}-\x{10FFFF}]]{1,12}|\S"
#: Ranges of ids that are dealt to tasks, at least; more for more shuffle partitions.
RANGES = 64


def _lit(n: int) -> Column:
    return F.lit(n).cast("long")


def _packed(hashed: Column, place: Column) -> Column:
    kept = F.shiftright(hashed, 64 - HASH_BITS).bitwiseAND(_lit((1 << HASH_BITS) - 1))
    return F.shiftleft(kept, PLACE_BITS).bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(_lit((1 << PLACE_BITS) - 1)).cast("int")


def _above(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the column ``out``: one number for each bin, all null if a text has
    no k-mer.

    A text of fewer symbols than a k-mer is one k-mer; a null or empty text has none.
    Every step is a projection of its own, so that it is computed once for a row.
    """
    names = [f"__{out}_{i}" for i in range(8)]
    symbols, kmers, ordered, again, runs, chosen, first, number = names
    at = F.col
    zero = _lit(0)

    def kmer(x: Column, i: Column) -> Column:
        more = [F.coalesce(F.get(at(symbols), i + j), zero) for j in range(1, K)]
        return F.xxhash64(x, *more)

    hashed = F.transform(
        F.regexp_extract_all(F.coalesce(at(text), F.lit("")), F.lit(SYMBOL), F.lit(0)),
        lambda x: F.xxhash64(x),
    )
    df = df.withColumn(symbols, hashed)
    n = F.greatest(F.size(symbols) - (K - 1), F.least(F.size(symbols), F.lit(1)))
    df = df.withColumn(kmers, F.transform(F.slice(symbols, F.lit(1), n), kmer))
    df = df.withColumn(ordered, F.sort_array(F.transform(kmers, _packed)))

    # Places in the sorted array whose k-mer was there before: they get numbers above
    # 0, by the distance to the begin of their run.
    def repeated(i: Column) -> Column:
        return (i > 0) & (_above(F.get(at(ordered), i)) == _above(F.get(at(ordered), i - 1)))

    df = df.withColumn(again, F.filter(_indices(F.size(ordered)), repeated))
    starts = F.filter(
        F.transform(again, lambda i, j: F.when(
            (j == 0) | (F.get(at(again), j - 1) != i - 1), j).otherwise(-1)),
        lambda j: j >= 0,
    )
    df = df.withColumn(runs, starts)

    def one(x: Column, occurrence: Column) -> Column:
        return _packed(F.xxhash64(F.get(at(kmers), _place(x)), occurrence), _place(x))

    def run(start: Column, r: Column) -> Column:
        past = F.coalesce(F.get(at(runs), r + 1), F.size(again))
        mine = F.slice(at(again), start + 1, past - start)
        return F.transform(mine, lambda i, j: one(F.get(at(ordered), i), j + 1))

    def fresh(x: Column, i: Column) -> Column:
        return (i == 0) | (_above(x) != _above(F.get(at(ordered), i - 1)))

    singles = F.transform(F.filter(ordered, fresh), lambda x: one(x, F.lit(0)))
    numbered = F.concat(singles, F.flatten(F.transform(runs, run)))
    df = df.withColumn(number, F.sort_array(numbered))

    # The smallest of each bin: those whose bin is another one so many places before.
    def bin_of(x: Column) -> Column:
        return F.shiftright(x, BIN_SHIFT)

    df = df.withColumn(
        chosen,
        F.filter(
            number,
            lambda x, i: (i < SELECTED) | (bin_of(F.get(at(number), i - SELECTED)) != bin_of(x)),
        ),
    )

    # Where each bin's tuple begins among the chosen: at its own first k-mer or, if the
    # bin is empty, at that of the next one that is not, round the circle.
    held = F.size(chosen)

    def bins_up_to(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(bin_of(F.get(at(chosen), i - 1)))
        return F.array_repeat(i, (bin_of(x) - before).cast("int"))

    last = bin_of(F.get(at(chosen), held - 1)).cast("int")
    begins = F.concat(
        F.flatten(F.transform(chosen, bins_up_to)),
        F.array_repeat(F.lit(0), F.lit(BINS - 1) - last),
    )
    df = df.withColumn(first, begins)

    def tuple_hash(start: Column) -> Column:
        mine = [_place(F.get(at(chosen), F.pmod(start + j, held))) for j in range(SELECTED)]
        # Round the circle a text of fewer k-mers meets the same ones again.
        places = F.sort_array(F.slice(F.array(*mine), F.lit(1), F.least(held, F.lit(SELECTED))))
        kept = F.transform(places, lambda p: F.get(at(kmers), p))
        return F.xxhash64(kept).bitwiseAND(_lit(0xFFFFFFFF))

    none = F.array_repeat(F.lit(None).cast("long"), BINS)
    df = df.withColumn(out, F.when(held == 0, none).otherwise(F.transform(first, tuple_hash)))
    return df.drop(*names)


def shown(signature: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits for each bin, dashes for none."""
    each = F.transform(
        signature, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x), 8, "0")), F.lit("-" * 8))
    )
    return F.array_join(each, "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among those that either text fills; 1 if neither has any."""
    both = F.zip_with(
        a, b,
        lambda x, y: F.when(x.isNull() & y.isNull(), 0).when(x.eqNullSafe(y), 1001).otherwise(1),
    )
    # One number holds both counts: the bins filled, and 1000 for each equal one.
    total = F.aggregate(both, F.lit(0), lambda s, x: s + x)
    filled = F.pmod(total, F.lit(1000))
    return F.when(filled == 0, F.lit(1.0)).otherwise(
        ((total - filled) / 1000).cast("double") / filled.cast("double")
    )


def _range(doc_id: Column, splits: list[int]) -> Column:
    """How many of the sorted ``splits`` are at most the id, in two steps of about the
    square root of their number; 0 for null."""
    step = max(1, int(len(splits) ** 0.5))
    groups = [splits[i : i + step] for i in range(0, len(splits), step)]
    if not groups:
        return F.lit(0)
    coarse = F.size(F.filter(F.lit([g[0] for g in groups]), lambda x: x <= doc_id))
    fine = F.size(F.filter(F.get(F.lit(groups), coarse - 1), lambda x: x <= doc_id))
    return F.when(coarse > 0, (coarse - 1) * step + fine).otherwise(0)


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with ``signature``, and ``next_text`` and
    ``next_signature`` of the row that follows by descending id; the first follows the
    last.  Equal ids are in the order of their hashed texts, null ids come last.

    Rows are dealt out by ranges of ids, and the first row of a range is also sent to
    the range before it: the texts are shuffled once, and no task sees all ids.
    """
    spark = docs.sparkSession
    wanted = max(RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / wanted for i in range(1, wanted)]
    splits = docs.agg(F.percentile_approx("doc_id", F.lit(shares), F.lit(100_000))).first()[0]
    own = _range(F.col("doc_id"), sorted(set(splits or [])))
    ranged = docs.select("doc_id", own.alias("range"))
    firsts = ranged.groupBy("range").agg(F.max("doc_id").alias("first")).orderBy("range").collect()
    # One row for each range, so small: who needs a copy of its first row.
    ranges = [r["range"] for r in firsts]
    needs = [
        (r["range"], r["first"], ranges[(i + 1) % len(ranges)]) for i, r in enumerate(firsts)
    ]
    lookup = spark.createDataFrame(needs, "range int, first bigint, before int")
    dealt = docs.select("doc_id", "text", own.alias("range")).join(F.broadcast(lookup), "range")
    copied = F.when(
        F.col("doc_id").eqNullSafe(F.col("first")),
        F.array(
            F.struct(F.col("range").alias("range"), F.lit(False).alias("copy")),
            F.struct(F.col("before").alias("range"), F.lit(True).alias("copy")),
        ),
    ).otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))))
    dealt = dealt.select("doc_id", "text", F.inline(copied)).repartition("range")
    dealt = signatures(dealt, "text", "signature")
    order = Window.partitionBy("range").orderBy(
        "copy", F.desc_nulls_last("doc_id"), F.xxhash64("text")
    )
    return dealt.select(
        "*",
        F.lead("text").over(order).alias("next_text"),
        F.lead("signature").over(order).alias("next_signature"),
    ).filter("NOT copy").drop("range", "copy")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every row's whole text, and of the text with its later half
    replaced by the beginning of the next document's.

    Returns ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (likeness to the edited
    text's, and the next document's, fingerprint).  The id is a whole number.  A null
    text reads as empty, and empty texts are alike; the only row is followed by itself;
    an empty table gives no rows; repeated rows stay repeated.
    """
    picked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )
    length = F.char_length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), length - half), F.substring("next_text", F.lit(1), half)
    )
    rows = with_next(picked).select(
        "doc_id", length.cast("long").alias("n_chars"), "signature", "next_signature",
        edited.alias("edited"),
    )
    rows = signatures(rows, "edited", "edited_signature")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("signature")).alias("fingerprint"),
        shown(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
