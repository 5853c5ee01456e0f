"""CSV records of files that many tasks read: cells over several lines, numbers in file
order, and bad records set apart (SRC-1, MAP-1).

Spark splits a text file at line feeds, wherever they stand, so a task can't tell by itself
whether its first line begins a record or goes on inside a quoted cell. But each line maps
those two states to the state behind it, whatever stands before: most lines keep the state,
some turn it round, some set it. Maps are composed per split, the splits' maps (a row per
split) are composed in file order, and so each line's state and each record's number follow
without any task seeing more than a split. Only the lines of records that span lines are
gathered by record.

Rules, as pandas reads: a cell is quoted when a quote is its first character; inside, a
quote is doubled; what follows a closing quote belongs to the cell; a line end outside of
quotes ends the record; blank lines aren't records; each file's first record is its header.
A record with more cells than the header, or whose quote is still open where its file ends,
is bad: it keeps its number and carries its ``problem``. Missing cells are NULL.

A line ends with a line feed, or a carriage return and a line feed. A carriage return alone
doesn't end a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A quoted cell's inside, and the cells before the last one of a line. No quantifier
#: gives back, so each pattern passes over a line once.
_INSIDE = '(?:[^"]|"")*+'
_CELLS = f'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'
#: A line that ends inside a quoted cell: begun outside of one, begun inside.
OPENED = f'(?s)^{_CELLS}"{_INSIDE}$'
STILL_OPEN = f'(?s)^{_INSIDE}(?:$|"[^,]*+,{_CELLS}"{_INSIDE}$)'
#: A cell with the comma before it.
CELL = f'(?s),("{_INSIDE}"[^,]*+|[^,]*+)'

TOO_MANY, OPEN_QUOTE = "more cells than the header", "a quote that is never closed"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, line``: every line of the files, by split and place in it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def _state(start: Column, set_to: Column, turns: Column) -> Column:
    """1 inside a quoted cell, else 0: what was set last, turned so many times since."""
    return F.pmod(F.coalesce(set_to["to"], start) + turns - F.coalesce(set_to["turns"], F.lit(0)), F.lit(2)).cast("int")


def _composed(df: DataFrame, from_out: str, from_in: str, window: Window, starts: dict[str, Column]) -> DataFrame:
    """``df`` with a state column for each of ``starts``: the state before the row, if the
    window's first row begins in that state. ``from_out`` and ``from_in`` are the states
    behind the row, begun outside and inside."""
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.when((F.col(from_out) == 1) & (F.col(from_in) == 0), 1).otherwise(0)
    counted = df.withColumn("_turns", F.coalesce(F.sum(turned).over(before), F.lit(0)))
    sets = F.when(F.col(from_out) == F.col(from_in), F.struct(F.col(from_out).alias("to"), F.col("_turns").alias("turns")))
    last = counted.withColumn("_set", F.last(sets, ignorenulls=True).over(before))
    states = {name: _state(start, F.col("_set"), F.col("_turns")) for name, start in starts.items()}
    return last.withColumns(states).drop("_turns", "_set")


def _lines_by_state(lines: DataFrame) -> DataFrame:
    """Per line, for its split begun outside (0) and inside (1) of a cell: the state before
    (``s0, s1``) and behind it (``t0, t1``) and the records begun so far (``k0, k1``)."""
    quoted = F.col("line").contains('"')
    mapped = lines.withColumns(
        {
            "from_out": F.when(quoted, F.col("line").rlike(OPENED).cast("int")).otherwise(0),
            "from_in": F.when(quoted, F.col("line").rlike(STILL_OPEN).cast("int")).otherwise(1),
        }
    )
    split = Window.partitionBy("file", "block").orderBy("at")
    states = _composed(mapped, "from_out", "from_in", split, {"s0": F.lit(0), "s1": F.lit(1)})
    upto = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blank = ~F.col("line").rlike(r"[^ \t\r]")
    out = {}
    for s in ("0", "1"):
        begins = (F.col(f"s{s}") == 0) & ~blank
        out[f"k{s}"] = F.sum(begins.cast("long")).over(upto)
        out[f"t{s}"] = F.when(F.col(f"s{s}") == 0, F.col("from_out")).otherwise(F.col("from_in"))
    return states.withColumns(out).withColumn("blank", blank).drop("from_out", "from_in")


def _splits(by_state: DataFrame) -> DataFrame:
    """A row per split: the state it begins in, how many records of its file begin before
    it, how many data records stand in earlier files, and whether its file ends inside a
    cell (``open_from``: the number of that record). The windows hold a row per split."""
    ends = by_state.groupBy("file", "block").agg(*[F.max_by(c, "at").alias(c) for c in ("t0", "t1", "k0", "k1")])
    file = Window.partitionBy("file").orderBy("block")
    begun = _composed(ends, "t0", "t1", file, {"start": F.lit(0)})
    own = F.when(F.col("start") == 0, F.col("k0")).otherwise(F.col("k1"))
    ending = F.when(F.col("start") == 0, F.col("t0")).otherwise(F.col("t1"))
    whole = Window.partitionBy("file")
    placed = begun.withColumns({"own": own, "ending": ending}).withColumns(
        {
            "before": F.coalesce(F.sum("own").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "in_file": F.sum("own").over(whole),
            "open": F.max_by("ending", "block").over(whole) == 1,
            "first": F.row_number().over(file) == 1,
        }
    )
    # Of earlier files, all records but their headers, which stand with each file's first split.
    data = F.col("own") - F.when(F.col("first") & (F.col("in_file") > 0), 1).otherwise(0)
    so_far = F.sum(data).over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    header = F.when(F.col("in_file") > 0, 1).otherwise(0)
    earlier = so_far - F.col("before") - F.col("own") + header
    return placed.select(
        "file", "block", "start", "before", earlier.alias("earlier"), F.when(F.col("open"), F.col("in_file")).alias("open_from")
    )


def records(lines: DataFrame) -> DataFrame:
    """``file, number, record, problem`` of every data record: ``number`` counts from 0 over
    all files by name, headers and blank lines left out."""
    by_state = _lines_by_state(lines)
    placed = by_state.join(_splits(by_state), ["file", "block"])
    inside = F.col("start") == 1
    numbered = placed.select(
        "file", "block", "at", "line", "blank", "earlier", "open_from",
        F.when(inside, F.col("s1")).otherwise(F.col("s0")).alias("state"),
        F.when(inside, F.col("t1")).otherwise(F.col("t0")).alias("after"),
        (F.col("before") + F.when(inside, F.col("k1")).otherwise(F.col("k0"))).alias("record"),
    ).where((F.col("record") > 1) & ~(F.col("blank") & (F.col("state") == 0)))
    number = (F.col("earlier") + F.col("record") - 2).alias("number")
    is_open = F.coalesce(F.col("record") == F.col("open_from"), F.lit(False))
    alone = (F.col("state") == 0) & ((F.col("after") == 0) | is_open)
    problem = F.when(is_open, F.lit(OPEN_QUOTE)).alias("problem")
    single = numbered.where(alone).select("file", number, F.col("line").alias("record"), problem)
    several = numbered.where(~alone & ~is_open).groupBy("file", number).agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("lines")
    )
    joined = several.select("file", "number", F.array_join(F.col("lines.line"), "\n").alias("record"), F.lit(None).cast("string").alias("problem"))
    return single.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def cells(record: Column) -> Column:
    """The cells of a whole record, as text."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CELL), 1)
    opened = f'(?s)^"({_INSIDE})"(.*)$'

    def value(cell: Column) -> Column:
        inside = F.replace(F.regexp_extract(cell, opened, 1), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), F.concat(inside, F.regexp_extract(cell, opened, 2))).otherwise(cell)

    return F.transform(raw, value)


def with_cells(rows: DataFrame, header: list[str]) -> DataFrame:
    """``number, problem, record`` and a column per header cell, NULL where empty or missing,
    and in all columns of a bad record."""
    split = rows.withColumn("_cells", F.when(F.col("problem").isNull(), cells(F.col("record"))))
    problem = F.coalesce("problem", F.when(F.size("_cells") > len(header), F.lit(TOO_MANY)))
    found = [F.when(problem.isNull(), F.nullif(F.get("_cells", F.lit(k)), F.lit(""))).alias(name) for k, name in enumerate(header)]
    return split.select("number", problem.alias("problem"), "record", *found)
