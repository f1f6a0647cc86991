"""Faults in conversations and the cheapest edits that mend them.

Rows are ordered by conversation and turn over all tasks, in parts of bounded size, and written.  A conversation within a part is
solved where it lies, by a program over persistent chains of edits (see :mod:`marquee.llm.audit`).  One that goes over several parts, however
long, is solved part by part for each state that it may begin in; which texts were seen in an earlier part is found by joins on
checksums.  Then only the edits, a byte per row and pair of states, meet to choose the way through the parts; every part makes
its repaired text, and the checksum runs over these one after the other without holding them.  Rows alike in everything
are counted before they move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.audit import EMPTY, ENDS, Costs, Row, best_path, cheapest, repaired
from marquee.llm.shipping import in_tasks, ship
from marquee.llm.storage import stored

#: About so many bytes of rows in a part.
PART_BYTES = 16 << 20
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_SPACE = r"\x20\x09-\x0D"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NAMES = ("conv", "turn", "role", "text", "times", "blank", "truncated", "repeated", "place")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by a checksum of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes out full stops, exclamation and question marks, 3 repeats it and 4 makes its role ``user``.
    A null role or text reads as one space, and so does a null in the checksum; a null ``turn`` stays null.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    read = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return read.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time")).drop("_time")


def _ordered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows alike counted, in order over all parts: ``place`` grows with it and says the part in its upper bits."""
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + F.octet_length("role") + 32)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("times"))
    faults = counted.select(
        "*",
        (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
        (~F.col("text").rlike(f"[.!?][{_SPACE}]*\\z")).alias("truncated"),
    )
    order = ["conv", "turn", "role", "text"]
    dealt = faults.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # A part is one file that one task reads in order.
    placed = dealt.withColumn("place", F.monotonically_increasing_id())
    return stored(spark, placed, "ordered", {"compression": "zstd", "maxRecordsPerFile": "0", "parquet.block.size": str(1 << 30)})


def _part(place: Column) -> Column:
    return F.shiftright(place, 33)


def _measured(rows: list[dict], seen: set[bytes]) -> dict:
    """Faults of consecutive rows of one conversation, as counts, and the rows as :class:`Row`."""
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    edits = []
    last = None
    for row in rows:
        initial, times = row["role"][:1], row["times"]
        if last is not None and (last, initial) not in _LEGAL:
            counts["illegal"] += 1
        if (initial, initial) not in _LEGAL:
            counts["illegal"] += times - 1
        last = initial
        if row["blank"]:
            counts["blank"] += times
            edits.append(Row(initial, True, False, times))
            continue
        mark = sha256(f"{len(row['role'])}:{row['role']}{row['text']}".encode()).digest()
        again = row["repeated"] or mark in seen
        seen.add(mark)
        counts["duplicate"] += times - 1 + again
        if again:
            edits.append(Row(initial, True, False, times))
            continue
        counts["truncated"] += row["truncated"]
        edits.append(Row(initial, False, row["truncated"]))
        if times > 1:
            edits.append(Row(initial, True, False, times - 1))
    turns = [row["turn"] for row in rows if row["turn"] is not None]
    return counts | {
        "edits": edits,
        "first": rows[0]["role"][:1],
        "last": last,
        "least": turns[0] if turns else None,
        "most": turns[-1] if turns else None,
        "turns": len(set(turns)),
    }


def _gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else min(most - least + 1 - turns, (1 << 63) - 1)


def _lines(rows: list[dict]) -> list[tuple[str, str, int]]:
    return [(row["role"], row["text"], row["times"]) for row in rows]


def _solved(rows: list[dict], costs: Costs) -> dict:
    """All results of a conversation that lies within a part."""
    found = _measured(rows, set())
    ways = cheapest(found["edits"], EMPTY, costs)
    cost, audit = min(ways[state] for state in ENDS if state in ways)
    kept = "\n".join(repaired(_lines(rows), audit))
    return {name: found[name] for name in ("blank", "duplicate", "truncated", "illegal")} | {
        "conv": rows[0]["conv"],
        "gaps": _gaps(found["least"], found["most"], found["turns"]),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": sha256(kept.encode()).hexdigest(),
    }


def _result_schema(conv: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", conv), *((n, pa.int64()) for n in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _ddl(rows: DataFrame) -> str:
    return f"conv {rows.schema['conv'].dataType.simpleString()}, {', '.join(f'{n} long' for n in _COUNTS)}, audit string, repaired_sha256 string"


def _within_parts(rows: DataFrame, costs: Costs) -> DataFrame:
    """Results of conversations whose rows come one after the other."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        done: list[dict] = []
        for batch in batches:
            schema = _result_schema(batch.schema.field("conv").type)
            for row in batch.to_pylist():
                if held and (held[0]["conv"] != row["conv"] or held[0]["place"] >> 33 != row["place"] >> 33):
                    done.append(_solved(held, costs))
                    held = []
                held.append(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if held:
            yield pa.RecordBatch.from_pylist([_solved(held, costs)], schema)

    return in_tasks(rows.select(*_NAMES), work, _ddl(rows))


_PIECE = "part long, first string, last string, least long, most long, turns long, blank long, duplicate long, truncated long, illegal long"


def _over_parts(spark: SparkSession, rows: DataFrame, costs: Costs) -> DataFrame:
    """Results of conversations that go over several parts."""
    ship(spark)
    kind = rows.schema["conv"].dataType.simpleString()
    marked = rows.select("*", _part(F.col("place")).alias("part"), F.sha2(F.concat_ws(":", F.char_length("role"), F.concat("role", "text")), 256).alias("mark"))
    marked = marked.drop("repeated")
    # A text is there once per part at most, so that no text is too frequent for these joins.
    texts = marked.where("NOT blank").select("conv", "part", "mark").distinct()
    begun = texts.groupBy(F.col("conv").alias("_conv"), F.col("mark").alias("_mark")).agg(F.min("part").alias("begun"))
    later = texts.join(begun, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("mark") == F.col("_mark")))
    later = later.where("part > begun").select("_conv", F.col("part").alias("_part"), "_mark", F.lit(True).alias("again"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("mark") == F.col("_mark"))
    known = marked.join(later, same, "left").withColumn("repeated", F.coalesce("again", F.lit(False)))
    known = stored(spark, known.select(*_NAMES, "part"), "long-conversations")

    def piece(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda row: row["place"])
        found = _measured(held, set())
        ways = {begin: cheapest(found["edits"], begin, costs) for begin in range(4)}
        steps = [(b, e, c, edits) for b, ends in ways.items() for e, (c, edits) in ends.items()]
        values = {name: [found[name]] for name in ("first", "last", "least", "most", "turns", "blank", "duplicate", "truncated", "illegal")}
        values |= {"conv": [held[0]["conv"]], "part": [held[0]["part"]]}
        values |= {name: [[step[k] for step in steps]] for k, name in enumerate(("begins", "ends", "costs", "edits"))}
        types = dict.fromkeys(values, pa.int64()) | {"conv": table.schema.field("conv").type, "first": pa.string(), "last": pa.string()}
        types |= {"begins": pa.list_(pa.int32()), "ends": pa.list_(pa.int32()), "costs": pa.list_(pa.int64()), "edits": pa.list_(pa.string())}
        return pa.table({name: pa.array(value, types[name]) for name, value in values.items()}).select(["conv", *order])

    more = "begins array<int>, ends array<int>, costs array<long>, edits array<string>"
    order = [field.split(" ")[0] for field in f"{_PIECE}, {more}".split(", ")]
    pieces = known.groupBy("conv", "part").applyInArrow(piece, f"conv {kind}, {_PIECE}, {more}")
    pieces = stored(spark, pieces, "pieces")

    def way(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda row: row["part"])
        parts = []
        for row in held:
            ways: dict[int, dict[int, tuple[int, str]]] = {}
            for begin, end, cost, edits in zip(row["begins"], row["ends"], row["costs"], row["edits"], strict=True):
                ways.setdefault(begin, {})[end] = (cost, edits)
            parts.append(ways)
        states = best_path(parts)
        return pa.table(
            {
                "conv": pa.array([row["conv"] for row in held], table.schema.field("conv").type),
                "part": pa.array([row["part"] for row in held], pa.int64()),
                "begin": pa.array(states[:-1], pa.int32()),
                "end": pa.array(states[1:], pa.int32()),
            }
        )

    asked = pieces.select("conv", "part", "begins", "ends", "costs", "edits")
    ways = asked.groupBy("conv").applyInArrow(way, f"conv {kind}, part long, begin int, end int")
    ways = ways.withColumnsRenamed({"conv": "_conv", "part": "_part"})
    chosen = pieces.join(ways, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
    found = F.expr("filter(arrays_zip(begins, ends, costs, edits), s -> s.begins = begin AND s.ends = end)[0]")
    named = [field.split(" ")[0] for field in _PIECE.split(", ")]
    chosen = chosen.select("conv", *named, "begin", found.alias("step")).select("conv", *named, "begin", F.col("step.costs").alias("cost"), F.col("step.edits").alias("audit"))

    def written(left: pa.Table, right: pa.Table) -> pa.Table:
        # The repaired lines of a part, next to its edits and counts.
        held = sorted(left.to_pylist(), key=lambda row: row["place"])
        row = right.to_pylist()[0]
        lines = list(repaired(_lines(held), row["audit"], row["begin"]))
        kept = right.append_column("lines", pa.array(["\n".join(lines)], pa.string()))
        return kept.append_column("some", pa.array([bool(lines)])).drop_columns(["begin"])

    kept = f"conv {kind}, {_PIECE}, cost long, audit string, lines string, some boolean"
    both = known.groupBy("conv", "part").cogroup(chosen.groupBy("conv", "part")).applyInArrow(written, kept)
    result = _ddl(rows)

    def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Chained | None = None
        for batch in batches:
            schema = _result_schema(batch.schema.field("conv").type)
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if now and now.row["conv"] != row["conv"]:
                    yield pa.RecordBatch.from_pylist([now.result()], schema)
                    now = None
                now = now or _Chained(row)
                now.take(row)
        if now:
            yield pa.RecordBatch.from_pylist([now.result()], schema)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return in_tasks(both.repartition(tasks, "conv").sortWithinPartitions("conv", "part"), chained, result)


class _Chained:
    """What is known of a conversation after some of its parts; the repaired text is not held."""

    def __init__(self, row: dict) -> None:
        self.row = row
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit: list[str] = []
        self.kept, self.some = sha256(), False
        self.last = self.least = self.most = None
        self.turns = 0

    def take(self, row: dict) -> None:
        for name in self.sums:
            self.sums[name] += row[name]
        if self.last is not None and (self.last, row["first"]) not in _LEGAL:
            self.sums["illegal"] += 1
        self.last = row["last"]
        if row["least"] is not None:
            # A turn may go over the end of a part.
            self.turns += row["turns"] - (row["least"] == self.most)
            self.least, self.most = row["least"] if self.least is None else self.least, row["most"]
        self.audit.append(row["audit"])
        if row["some"]:
            if self.some:
                self.kept.update(b"\n")
            self.kept.update(row["lines"].encode())
            self.some = True

    def result(self) -> dict:
        return self.sums | {
            "conv": self.row["conv"],
            "gaps": _gaps(self.least, self.most, self.turns),
            "audit": "".join(self.audit),
            "repaired_sha256": self.kept.hexdigest(),
        }


def repair(spark: SparkSession, conversations: DataFrame, asked: DataFrame | None = None, costs: Costs = Costs()) -> DataFrame:
    """Per conversation ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``conversations`` has ``conv_id, turn, role, text``, in any order; rows go by turn (nulls first, equal turns by role and
    text).  A row's first fault counts: blank, a role and text seen earlier, or an end without ``.``, ``!`` or ``?``.  ``illegal`` are
    adjacent roles other than system-user, user-assistant and assistant-user, by their initials, and ``gaps`` the turns missing
    between the first and last one.  ``audit`` are the initials of the cheapest edits Keep, Rerole, Delete and Insert that lead to an
    optional system row and pairs of user and assistant, or to nothing; ties go to the first in ASCII order.

    A null role or text is one space; a role that is empty or begins with another letter cannot be kept.  Rows with a null ``conv_id``
    are one conversation.  ``asked`` lists in ``conv_id`` what conversations to return; those without a row have
    zeros, an empty audit and the checksum of nothing.  Without it those that have rows are.  Other columns are left out.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    ordered = _ordered(spark, rows).withColumn("repeated", F.lit(False))
    part = _part(F.col("place"))
    spans = ordered.groupBy("conv").agg(F.min(part).alias("least"), F.max(part).alias("most"))
    # At every boundary of two parts at most one conversation goes on.
    long = F.broadcast(stored(spark, spans.where("least <> most").select(F.col("conv").alias("_conv")), "long"))
    goes_on = F.col("conv").eqNullSafe(F.col("_conv"))
    near = _within_parts(ordered.join(long, goes_on, "left_anti"), costs)
    far = _over_parts(spark, ordered.join(long, goes_on, "left_semi"), costs)
    found = near.unionByName(far).withColumnRenamed("conv", "conv_id")
    if asked is None:
        return found
    wanted = asked.select(F.col("conv_id").alias("_conv")).distinct()
    every = wanted.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero, nothing = F.lit(0).cast("long"), F.lit("")
    return every.select(
        F.col("_conv").alias("conv_id"),
        *(F.coalesce(name, zero).alias(name) for name in _COUNTS),
        F.coalesce("audit", nothing).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(nothing.cast("binary"), 256)).alias("repaired_sha256"),
    )
