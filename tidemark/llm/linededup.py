"""Line deduplication over a suffix array of line ids, in DataFrame functions only.

A line's id is the digest of its bytes. Only lines that occur twice can lie in a repeated run, so suffixes start there and end
before the next line that is unique, or with their text. Prefix doubling ranks them: after round j a suffix is ordered by its first
2 ** j lines, as (first line, offset among the suffixes with that first line); a round looks 2 ** j lines on (a lead within the
stretch), counts the distinct pairs of ranks before any shuffle, and sums the counts below. Suffixes with a longest common prefix
of l lines or more form an interval of the array; two ranks of the greatest power of two below l, at its start and end, name it.

A run counts as repeated if it has min_words words or more. Every line of such a run lies in a smallest window with that many
words, forward from a line or backward from one, and equal windows are cut alike wherever they occur; so it is enough to look up
these windows. In each interval the occurrence that is first by (key, row, line) stays; the lines of all later ones are deleted.

Defined cases: a null text has no lines and stays null; an empty text is one empty line; lines without a word count only inside a
run. Null keys come first in order; rows that repeat a key are told apart. Runs may overlap themselves. An empty table gives an empty
result. Input columns named like the outputs (n_lines, n_removed) are replaced; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise


def _words(line: Column) -> Column:
    """Words of a line, parted by blanks or tabs."""
    return F.size(F.array_remove(F.split(line, r"[ \t\r\f]+"), ""))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines (uid, key, line, id, words) whose id occurs twice, with their stretch: runs of such lines without a gap."""
    often = lines.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    place = F.row_number().over(Window.partitionBy("uid").orderBy("line"))
    return lines.join(often, "id").withColumn("stretch", F.col("line") - place)


def windows(suffixes: DataFrame, min_words: int) -> DataFrame:
    """(uid, start, length): the smallest windows of a stretch with min_words words, forward from each line and backward from it.

    Lines and questions are sorted together by words so far, so each question finds its line by one running `last`.
    """
    along = Window.partitionBy("uid", "stretch").orderBy("line")
    summed = suffixes.select("uid", "stretch", "line", "words", F.sum("words").over(along).alias("upto")).withColumn("before", F.col("upto") - F.col("words"))

    def ask(v: Column, question: Column, backward: bool) -> DataFrame:
        line = summed.select("uid", "stretch", v.alias("v"), F.lit(0).alias("asks"), "line")
        asked = summed.select("uid", "stretch", question.alias("v"), F.lit(1).alias("asks"), "line")
        order = [F.col("v"), F.col("asks"), F.col("line")] if backward else [F.col("v").desc(), F.col("asks"), F.col("line").desc()]
        sight = Window.partitionBy("uid", "stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        other = F.last(F.when(F.col("asks") == 0, F.col("line")), ignorenulls=True).over(sight)
        return line.unionByName(asked).withColumn("other", other).where("asks = 1 and other is not null")

    forward = ask(F.col("upto"), F.col("before") + min_words, False).select("uid", F.col("line").alias("start"), (F.col("other") - F.col("line") + 1).alias("length"))
    backward = ask(F.col("before"), F.col("upto") - min_words, True).select("uid", F.col("other").alias("start"), (F.col("line") - F.col("other") + 1).alias("length"))
    return forward.unionByName(backward).where("length > 0").distinct()


def ranks(suffixes: DataFrame, rounds: int) -> DataFrame:
    """suffixes with offsets o0 to o<rounds>: o<j> orders, among suffixes with the same first line, their first 2 ** j lines."""
    table = suffixes.withColumn("o0", F.lit(0).cast("long"))
    along = Window.partitionBy("uid", "stretch").orderBy("line")
    for j in range(rounds):
        table = materialise(
            table.withColumns({"next_id": F.lead("id", 1 << j).over(along), "next_o": F.lead(f"o{j}", 1 << j).over(along)}), "suffixes"
        )
        group = ["id", f"o{j}"]
        pairs = table.groupBy(*group, "next_id", "next_o").agg(F.count("*").alias("n"))
        below = Window.partitionBy(*group).orderBy(F.col("next_id").asc_nulls_first(), F.col("next_o").asc_nulls_first())
        keys = [*group, "next_id", "next_o"]
        ranked = pairs.select(*(F.col(c).alias(f"r_{c}") for c in keys), (F.col(f"o{j}") + F.sum("n").over(below) - F.col("n")).alias(f"o{j + 1}"))
        same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) if c.startswith("next") else F.col(c) == F.col(f"r_{c}") for c in keys]
        table = table.join(ranked, same).drop("next_id", "next_o", *(f"r_{c}" for c in keys))
    return table


def later_windows(suffixes: DataFrame, min_words: int) -> DataFrame:
    """(uid, start, length) of the windows whose lines occur earlier."""
    cut = materialise(windows(suffixes, min_words), "windows")
    longest = cut.agg(F.max("length")).first()[0] or 0
    if not longest:
        return cut
    rounds = longest.bit_length() - 1
    ranked = materialise(ranks(suffixes, rounds), "ranks")
    level = F.floor(F.log2("length") + 1e-9).cast("int")
    offsets = F.array(*(F.col(f"o{j}") for j in range(rounds + 1)))
    sides = cut.withColumn("level", level).withColumn("tail", F.expr("start + length - shiftleft(1, level)"))
    at = ranked.select("uid", "line", "id", "key", offsets.alias("o"))
    head = sides.join(at, [sides["uid"] == at["uid"], sides["start"] == at["line"]]).select(sides["uid"], "key", "start", "length", "level", "tail", F.col("id").alias("a"), F.expr("o[level]").alias("ao"))
    end = at.select(F.col("uid").alias("u"), F.col("line").alias("l"), F.col("id").alias("b"), F.col("o").alias("bo"))
    named = head.join(end, [head["uid"] == end["u"], head["tail"] == end["l"]]).select("uid", "key", "start", "length", "a", "ao", "b", F.expr("bo[level]").alias("bo"))
    named = materialise(named, "intervals")
    place = F.struct("key", "uid", "start")
    interval = ["length", "a", "ao", "b", "bo"]
    first = named.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return named.join(first, interval).where(place > F.col("first")).select("uid", "start", "length")


def maximal_runs(found: DataFrame) -> DataFrame:
    """(uid, first, last): windows that overlap or touch, as runs of lines."""
    order = Window.partitionBy("uid").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("uid", "start", (F.col("start") + F.col("length") - 1).alias("last"))
    opened = spans.withColumn("opens", (F.col("start") > F.coalesce(F.max("last").over(order), F.lit(-2)) + 1).cast("int"))
    run = F.sum("opens").over(Window.partitionBy("uid").orderBy("start", "last"))
    return opened.withColumn("run", run).groupBy("uid", "run").agg(F.min("start").alias("first"), F.max("last").alias("last")).drop("run")


def remove_repeated_runs(rows: DataFrame, key: str, text: str, min_words: int = 25) -> DataFrame:
    """rows with the later copies of repeated runs of lines deleted from the text, n_lines and n_removed."""
    base = rows.drop("n_lines", "n_removed")
    # the row travels as one struct, so that no column of it can clash
    numbered = materialise(base.select(F.monotonically_increasing_id().alias("uid"), F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("row")), "numbered")
    body, own = F.col("row")[text], F.col("row")[key]
    texts = numbered.select("uid", own.alias("key"), F.posexplode(F.split(body, "\n")).alias("line", "body"))
    lines = materialise(texts.select("uid", "key", "line", F.unhex(F.md5(F.col("body").cast("binary"))).alias("id"), _words(F.col("body")).alias("words")), "lines")
    suffixes = materialise(repeated_lines(lines), "repeated")
    discard(lines)
    runs = maximal_runs(later_windows(suffixes, min_words))
    per_row = runs.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"), F.sum(F.col("last") - F.col("first") + 1).alias("gone"))
    joined = numbered.join(per_row, "uid", "left")
    whole = F.split(body, "\n")
    # what lies between the runs, in order
    starts = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["last"] + 1))
    ends = F.concat(F.transform("runs", lambda r: r["first"]), F.array(F.size(whole)))
    kept = F.flatten(F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda z: F.slice(whole, z["s"] + 1, z["e"] - z["s"])))
    cleaned = F.when(F.col("runs").isNull(), body).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(body.isNull(), 0).otherwise(F.size(whole)).cast("long")
    return joined.select(*((cleaned if c == text else F.col("row")[c]).alias(c) for c in base.columns), n_lines.alias("n_lines"), F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"))
