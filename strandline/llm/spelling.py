"""Words that differ by one letter, by pairs of trie nodes.

All words are numbered in code-point order and laid into two tries, one of the words
and one of the words reversed.  A word that leaves out its i-th code point is the pair
of the node of what comes before and the node (of the reversed trie) of what comes
after: two numbers, however long the word.  Words that share such a pair differ there
by one replaced code point; a word whose own cut between two code points is that pair
is the shorter one of an insertion.  A pair stands for one text with one hole, so at
most one word for each letter of the alphabet (and one without) meets at it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import written

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A word is the form of another from this many times its count on.
TIMES = 5
#: One in so many occurrences loses a letter (see ``occurrences``).
SLIPS = 199
#: Code points of words that one numbering task takes at a time, about.
PART = 4_000_000
#: Low bits of a node's number; above them is the part that it belongs to.
LOW = 40

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` for every maximal run of at least ``LEAST_LETTERS`` letters (A-Z, a-z,
    U+00C0 to U+00FF) of whole texts, with A-Z in lower case.

    Where ``SLIPS`` divides the crc32 of ``<doc_id>:<word>`` (a null id counts as ''),
    the code point at that crc32 modulo the length is left out.
    """
    letters = f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"
    run = F.translate(F.col("run"), _UPPER, _LOWER)
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(text, F.lit(letters), F.lit(0))).alias("run"),
    ).select("doc", run.alias("run"))
    h = F.crc32(F.encode(F.concat("doc", F.lit(":"), "run"), "UTF-8"))
    cut = F.pmod("h", F.length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    return runs.select("run", h.alias("h")).select(
        F.when(F.col("h") % SLIPS == 0, short).otherwise(F.col("run")).alias("word")
    )


def counted(words: DataFrame) -> DataFrame:
    """``word``, ``n`` for words long and frequent enough."""
    return (
        words.filter(F.length("word") >= LEAST_LETTERS)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


class Trie:
    """Node numbers for the words of one part, taken in order.

    The nodes on the path of the last word of a part are numbered by part and depth,
    so that later parts, which know all last words, name the same nodes.  All others
    are counted.  The root is 0.
    """

    def __init__(self, part: int, lasts: list[str]):
        self.lasts, self.part = lasts, part
        self.counted = 1 << (LOW - 1)
        self.word, self.path = "", [0]

    def _outer(self, prefix: str) -> int | None:
        """The number of a node on the path of the last word of this part or one before."""
        owner = bisect_left(self.lasts, prefix)
        if owner <= self.part and self.lasts[owner].startswith(prefix):
            return owner << LOW | len(prefix)
        return None

    def add(self, word: str) -> list[int]:
        """Numbers of the nodes of all prefixes, from the root to the whole word."""
        same = 0
        for a, b in zip(word, self.word):
            if a != b:
                break
            same += 1
        path = self.path[: same + 1]
        # Only paths of last words are shared with other parts; past the first node
        # that is not, none is.
        at = same + 1
        outer = self._reach(word)
        while at <= len(word):
            if at <= outer:
                path.append(self._outer(word[:at]))
            else:
                path.append(self.part << LOW | self.counted)
                self.counted += 1
            at += 1
        self.word, self.path = word, path
        return path

    def _reach(self, word: str) -> int:
        """The longest prefix that is on the path of a last word of this part or before:
        of all of them the nearest in order share the longest."""
        at = bisect_left(self.lasts, word)
        reach = 0
        for i in (at - 1, at):
            if 0 <= i <= self.part:
                n = 0
                for a, b in zip(word, self.lasts[i]):
                    if a != b:
                        break
                    n += 1
                reach = max(reach, n)
        return reach


def node_paths(words: DataFrame, word: str, id_column: str) -> DataFrame:
    """``id_column`` and ``nodes`` (node of every prefix of ``word``, root first).

    The distinct words are sorted into parts of even size; each part is numbered on
    its own, given the last word of every part (one per task of the sort).  A part is
    one group of bounded size.
    """
    letters = words.agg(F.sum(F.length(word).cast("long") + 1)).first()[0] or 0
    parts = max(1, -(-letters // PART))
    ordered = written(
        words.select(id_column, F.col(word).alias("word"))
        .repartitionByRange(parts, "word")
        .withColumn("part", F.spark_partition_id()),
        "spelling-parts",
    )
    found = ordered.groupBy("part").agg(F.max("word").alias("last")).orderBy("part").collect()
    place = {r["part"]: i for i, r in enumerate(found)}
    lasts = [r["last"] for r in found]

    def number(group: pa.Table) -> pa.Table:
        group = group.sort_by("word")
        trie = Trie(place[group["part"][0].as_py()], lasts)
        nodes = [trie.add(w) for w in group["word"].to_pylist()]
        return pa.table(
            {id_column: group[id_column], "nodes": pa.array(nodes, pa.list_(pa.int64()))}
        )

    return ordered.groupBy("part").applyInArrow(number, f"{id_column} bigint, nodes array<bigint>")


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id``: numbers that rise in code-point order of ``word``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << LOW
        for batch in batches:
            ids = pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([ids, *batch.columns], ["id", "word", "n"])

    letters = words.agg(F.sum(F.length("word").cast("long"))).first()[0] or 0
    parts = max(1, -(-letters // PART))
    ordered = words.select("word", "n").repartitionByRange(parts, "word").sortWithinPartitions("word")
    return ordered.mapInArrow(number, "id bigint, word string, n bigint")


def holes(words: DataFrame) -> DataFrame:
    """``id``, ``n`` and the pair (``before``, ``after``) for every code point left out of
    a word (``whole`` false; ``once``: the first of a run of equal ones) and every cut
    between two (``whole`` true)."""
    forward = node_paths(words, "word", "id")
    backward = node_paths(words.select("id", F.reverse("word").alias("drow")), "drow", "id")
    both = (
        words.join(forward.withColumnRenamed("nodes", "fore"), "id")
        .join(backward.withColumnRenamed("nodes", "back"), "id")
    )
    size = F.length("word")
    pair = lambda whole: lambda i: F.struct(
        F.get("fore", i).alias("before"),
        F.get("back", size - i - (0 if whole else 1)).alias("after"),
        F.lit(whole).alias("whole"),
        (F.lit(True) if whole else (i == 0) | (F.col("word").substr(i, F.lit(1)) != F.col("word").substr(i + 1, F.lit(1)))).alias("once"),
    )
    out = F.transform(F.sequence(F.lit(0), size - 1), pair(False))
    cut = F.transform(F.sequence(F.lit(0), size), pair(True))
    return both.select("id", "n", F.explode(F.concat(out, cut)).alias("pair")).select(
        "id", "n", "pair.*"
    )


def neighbours(pairs: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best``, the (least, id) of the neighbour with the largest
    count and then the smallest number; ``least`` is its count below zero.

    A pair brings at most one word per letter together (and one whole one), so its
    window is small whatever the data.
    """
    at = Window.partitionBy("before", "after")
    order = at.orderBy("whole", "least", "id")
    own = F.struct("least", "id")
    # Words that leave something out are the neighbours of each other: the first of
    # them, for the first itself the second.
    short = F.count(F.when(~F.col("whole"), 1)).over(at)
    first = F.min(F.when(~F.col("whole"), own)).over(at)
    second = F.min(F.when(~F.col("whole") & (F.col("turn") == 2), own)).over(at)
    met = (
        pairs.withColumn("least", -F.col("n"))
        .withColumn("turn", F.row_number().over(order))
        .select(
            "id", "whole", "once", "turn", short.alias("short"), first.alias("first"),
            second.alias("second"),
            F.count(F.when(F.col("whole"), 1)).over(at).alias("shorter"),
            F.min(F.when(F.col("whole"), own)).over(at).alias("shorter_word"),
            F.count(F.when(~F.col("whole") & F.col("once"), 1)).over(at).alias("longer"),
        )
        .filter(F.col("short") + F.col("shorter") > 1)
    )
    replaced = F.when(F.col("turn") == 1, F.col("second")).otherwise(F.col("first"))
    near = F.when(F.col("whole"), F.col("longer")).otherwise(
        F.col("short") - 1 + F.when(F.col("once"), F.col("shorter")).otherwise(0)
    )
    best = F.when(F.col("whole"), F.col("first")).otherwise(F.least(replaced, "shorter_word"))
    return (
        met.select("id", near.alias("near"), best.alias("best"))
        .groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def rooted(forms: DataFrame) -> DataFrame:
    """``id``, ``root`` for the pairs ``id``, ``up`` of ``forms``: where following them ends.

    Every step multiplies the count by ``TIMES``, so paths are short; each round
    doubles the steps that a pair stands for.
    """
    state = written(forms.select("id", F.col("up").alias("root"), F.lit(False).alias("done")), "spelling-roots")
    while not state.filter("NOT done").isEmpty():
        nxt = state.select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("done").alias("last"))
        state = written(
            state.join(nxt, "root", "left").select(
                "id", F.coalesce("next", "root").alias("root"), (F.col("next").isNull() | F.col("last")).alias("done")
            ),
            "spelling-roots",
        )
    return state.select("id", "root")


def grouped(words: DataFrame) -> DataFrame:
    """For each row of ``words`` (``word``, ``n``; distinct words of at least one code
    point): ``word``, its ``form`` (the word within one inserted, deleted or replaced code
    point that has the largest count, ties the smallest in code-point order, if that is
    at least ``TIMES`` its own; else null), ``root`` (where forms lead), ``n``, ``n_near``
    (words within one code point) and ``form_n``.  No words give no rows."""
    known = written(numbered(words), "spelling-words")
    near = neighbours(holes(known)).select("id", "n_near", -F.col("best.least"), F.col("best.id"))
    near = near.toDF("id", "n_near", "best_n", "best_id")
    some = F.col("best_n") >= TIMES * F.col("n")
    marked = written(
        known.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(some, F.col("best_id")).alias("up"), F.when(some, F.col("best_n")).alias("form_n"),
        ),
        "spelling-near",
    )
    led = marked.filter("up IS NOT NULL")
    roots = rooted(led.select("id", "up"))
    named = known.select("id", "word")
    spelt = (
        led.join(named.toDF("up", "form"), "up").select("id", "form")
        .join(roots.join(named.toDF("root", "end"), "root").select("id", F.col("end").alias("root")), "id")
    )
    return marked.join(spelt, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The spelling variants (see ``grouped``) among the words of whole texts.

    Null and empty texts have no words; repeated rows count each; a null id counts
    as ''.  An empty table gives no rows.
    """
    words = written(counted(occurrences(docs, doc_id, text)), "spelling-counts")
    return grouped(words)
