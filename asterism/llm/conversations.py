"""Conversation structure repair by weighted parsing of intervals.

The rows of a conversation are a string that has to become ``(s?(ua)+)?`` by
role initials. A repair keeps, re-roles or deletes every row and inserts empty
turns; the parse finds the cheapest one, of those the one whose audit, the
initials of its edits in order, is ASCII-least.

The grammar is in Chomsky normal form. A category tells the first and last
initial of what a span of rows is repaired to: ``EE`` for nothing, ``ss su sa uu
ua au aa``. The binary rules are ``fl -> fm nl`` wherever ``n`` may follow ``m``, and
``x -> x EE | EE x``; a single row yields the categories its edits allow; every
cell is closed under inserted turns at either end. The start is ``EE``, ``ua`` or
``sa``. A cell holds the least (cost, audit) of each category.

Any text of a category, cut between any two rows, falls into two texts of
categories that a rule joins. So the cell of a span is the same whichever cut it
is made from, and one cut will do: spans are combined bottom-up by their
length, two equal ones at a time. Costs decide before audits do. Two audits of
the same rows and cost are never one the beginning of the other, since the
longer one has inserted more, so the least of parts is the least of the whole.

On Spark: rows are sorted by a range partitioning, blocks of consecutive rows
become cells in tasks of their own, and the cells of a conversation that spans
several blocks are combined round by round. No task holds more than a block of
rows or cells. The audit of a conversation is one value, as long as its rows are
many. The last step writes the turns, or digests them, in one pass over the
sorted rows; only the digest of a conversation is by its nature sequential.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import small_batches, stored

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
FOLLOWS = {"su", "ua", "au"}
NOTHING = "EE"
CATEGORIES = (NOTHING, "ss", "su", "sa", "uu", "ua", "au", "aa")
COMPLETE = (NOTHING, "ua", "sa")
RULES = [
    (x, y, y if x == NOTHING else x if y == NOTHING else x[0] + y[1])
    for x in CATEGORIES
    for y in CATEGORIES
    if NOTHING in (x, y) or x[1] + y[0] in FOLLOWS
]
ROLES = {"u": "user", "a": "assistant"}
BLOCK_BITS = 10  # of rows, or cells, that one task combines at a time

# Cost and audit of each category of a span.
Cell = dict[str, tuple[int, str]]


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3  # of a truncated row that stays


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for x, y, z in RULES:
        if x in left and y in right:
            (cost_x, audit_x), (cost_y, audit_y) = left[x], right[y]
            cost = cost_x + cost_y
            best = out.get(z)
            if best is None or cost < best[0]:
                out[z] = (cost, audit_x + audit_y)
            elif cost == best[0]:
                out[z] = min(best, (cost, audit_x + audit_y))
    return out


def inserted(costs: Costs) -> Cell:
    one, two = (costs.insert, "I"), (2 * costs.insert, "II")
    return {NOTHING: (0, ""), "uu": one, "aa": one, "ua": two, "au": two}


@lru_cache(maxsize=64)
def row_cell(initial: str, must_go: bool, truncated: bool, costs: Costs) -> Cell:
    """What the edits of one row allow, and the same with inserted turns around it."""
    cell: Cell = {NOTHING: (costs.delete, "D")}
    if not must_go:
        extra = costs.truncated if truncated else 0
        cell["uu"] = cell["aa"] = (costs.rerole + extra, "R")
        if initial in ("s", "u", "a"):
            cell[initial * 2] = (extra, "K")
    around = inserted(costs)
    return joined(joined(around, cell), around)


def combined(cells: Iterable[Cell]) -> Cell | None:
    """One cell for consecutive spans, by length of span: runs of 1, 2, 4 and so on."""
    level = list(cells)
    while len(level) > 1:
        pairs = [joined(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0] if level else None


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[x] for x in COMPLETE if x in cell)


# --- rows in order ---------------------------------------------------------


def in_order(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, blank, truncated, digest, place), sorted and written.

    ``place`` rises with conversation and turn. Rows of one turn are ordered by
    role, the first characters of their text and its digest; equal rows may be
    split over tasks.
    """
    rows = df.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    trimmed = F.rtrim("text", F.lit(SPACES))
    rows = rows.withColumns(
        {
            "blank": trimmed == "",
            "truncated": (trimmed != "") & ~F.right(trimmed, F.lit(1)).isin(*ENDS),
            "digest": F.sha2("text", 256),
            "_head": F.left("text", F.lit(64)),
            "_salt": F.monotonically_increasing_id(),
        }
    )
    keys = ["conv", "turn", "role", "_head", "digest", "_salt"]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_head", "_salt")
    return stored(sorted_.withColumn("place", F.monotonically_increasing_id()), "turns")


def with_faults(ordered: DataFrame) -> DataFrame:
    """(conv, turn, place, initial, fault) of every row; the first fault of a row counts.

    A row is a duplicate if its role and text stood in the conversation before.
    The first place of each is found by a grouping and joined by place, which
    is unique, so no hot text meets in a join.
    """
    firsts = ordered.groupBy("conv", "role", "digest").agg(F.min("place").alias("place"))
    firsts = stored(firsts.select("place", F.lit(True).alias("first")), "firsts")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(F.col("truncated"), "truncated")
    )
    narrow = ordered.select("conv", "turn", "place", "role", "blank", "truncated")
    return narrow.join(firsts, "place", "left").select(
        "conv", "turn", "place", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault")
    )


# --- cells of blocks -------------------------------------------------------


@dataclass
class Span:
    """What is known of consecutive rows of a conversation."""

    cell: Cell
    first: str
    last: str
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0


COUNTS = ("blank", "duplicate", "truncated", "illegal")
SPAN = (
    "conv {conv}, block bigint, costs array<bigint>, audits array<string>, first string, last string, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def merged(spans: list[Span]) -> Span:
    out = Span(combined(span.cell for span in spans), spans[0].first, spans[-1].last)
    for name in COUNTS:
        setattr(out, name, sum(getattr(span, name) for span in spans))
    out.illegal += sum(a.last + b.first not in FOLLOWS for a, b in zip(spans, spans[1:], strict=False))
    return out


def _packed(found: list[tuple[object, int, Span]], kind: pa.DataType) -> pa.Table:
    columns = {
        "conv": pa.array([conv for conv, _, _ in found], kind),
        "block": pa.array([block for _, block, _ in found], pa.int64()),
        "costs": pa.array(
            [[s.cell[x][0] if x in s.cell else None for x in CATEGORIES] for *_, s in found],
            pa.list_(pa.int64()),
        ),
        "audits": pa.array(
            [[s.cell[x][1] if x in s.cell else None for x in CATEGORIES] for *_, s in found],
            pa.list_(pa.string()),
        ),
    }
    for name in ("first", "last"):
        columns[name] = pa.array([getattr(s, name) for *_, s in found], pa.string())
    for name in COUNTS:
        columns[name] = pa.array([getattr(s, name) for *_, s in found], pa.int64())
    return pa.table(columns)


def _runs(convs: list) -> Iterator[tuple[int, int]]:
    start = 0
    for at in range(1, len(convs) + 1):
        if at == len(convs) or convs[at] != convs[start]:
            yield start, at
            start = at


def _rows_to_spans(costs: Costs) -> Callable[[pa.Table], pa.Table]:
    def spans(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        convs, block = rows.column("conv").to_pylist(), rows.column("block")[0].as_py()
        initials, faults = rows.column("initial").to_pylist(), rows.column("fault").to_pylist()
        found = []
        for start, end in _runs(convs):
            parts = []
            for initial, fault in zip(initials[start:end], faults[start:end], strict=True):
                cell = row_cell(initial, fault in ("blank", "duplicate"), fault == "truncated", costs)
                part = Span(cell, initial, initial)
                if fault:
                    setattr(part, fault, 1)
                parts.append(part)
            found.append((convs[start], block, merged(parts)))
        return _packed(found, rows.schema.field("conv").type)

    return spans


def _cells_to_spans(table: pa.Table) -> pa.Table:
    rows = table.sort_by("block").to_pylist()
    spans = []
    for row in rows:
        known = zip(CATEGORIES, row["costs"], row["audits"], strict=True)
        cell = {x: (cost, audit) for x, cost, audit in known if cost is not None}
        counts = {name: row[name] for name in COUNTS}
        spans.append(Span(cell, row["first"], row["last"], **counts))
    found = [(rows[0]["conv"], rows[0]["next"], merged(spans))]
    return _packed(found, table.schema.field("conv").type)


def parsed(faulty: DataFrame, costs: Costs) -> DataFrame:
    """(conv, cost, audit, blank, duplicate, truncated, illegal) of every conversation."""
    schema = SPAN.format(conv=faulty.schema["conv"].dataType.simpleString())
    blocked = faulty.withColumn("block", F.shiftright("place", BLOCK_BITS))
    cells = blocked.groupBy("block").applyInArrow(_rows_to_spans(costs), schema)
    done, cells = None, stored(cells, "spans")
    while True:
        several = cells.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1")
        several = stored(several.select(F.col("conv").alias("again")), "several")
        alike = F.col("conv").eqNullSafe(F.col("again"))
        single = cells.join(several, alike, "left_anti")
        done = single if done is None else done.unionByName(single)
        if several.isEmpty():
            break
        cells = cells.join(several, alike, "left_semi")
        cells = cells.withColumn("next", F.shiftright("block", BLOCK_BITS))
        cells = stored(cells.groupBy("conv", "next").applyInArrow(_cells_to_spans, schema), "spans")

    # The cheapest of the complete categories, and of those the least audit.
    complete = [
        F.struct(F.col("costs")[at].alias("cost"), F.col("audits")[at].alias("audit"))
        for at, category in enumerate(CATEGORIES)
        if category in COMPLETE
    ]
    known = F.filter(F.array(*complete), lambda x: x["cost"].isNotNull())
    least = F.array_min(known)
    return done.select("conv", least["cost"].alias("cost"), least["audit"].alias("audit"), *COUNTS)


# --- repaired turns --------------------------------------------------------


@dataclass
class _Walk:
    """Reads the rows of one conversation along its audit."""

    audit: str
    at: int = 0
    last: str = ""
    out: list[tuple[str, str, str]] = field(default_factory=list)

    def _next_role(self) -> str:
        return ROLES["a" if self.last == "u" else "u"]

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = self._next_role()
            self.at, self.last = self.at + 1, role[:1]
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        role = role if edit == "K" else self._next_role()
        self.last = role[:1]
        yield edit, role, text


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object, tuple | None]]:
    """("turn", conversation, (edit, role, text)) of all repaired turns, and ("end", conversation, None)."""
    walk, conv = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:  # the row in front of a conversation
                if walk:
                    yield from (("turn", conv, turn) for turn in walk.inserts())
                    yield "end", conv, None
                walk, conv = _Walk(row["audit"]), row["conv"]
            else:
                yield from (("turn", conv, turn) for turn in walk.row(row["role"], row["text"]))
    if walk:
        yield from (("turn", conv, turn) for turn in walk.inserts())
        yield "end", conv, None


def _along(ordered: DataFrame, parses: DataFrame) -> DataFrame:
    """Rows of each conversation in order, behind one row that has its audit."""
    small_batches(ordered.sparkSession)
    rows = ordered.select("conv", "place", "role", "text", F.lit(None).cast("string").alias("audit"))
    nothing = F.lit(None).cast("string")
    heads = parses.select(
        "conv", F.lit(-1).cast("bigint").alias("place"), nothing.alias("role"), nothing.alias("text"), "audit"
    )
    return rows.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "place")


def digests(ordered: DataFrame, parses: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): digest of ``role:text`` of the repaired turns, newline-joined."""
    kind = ordered.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, found, digest, first = [], [], hashlib.sha256(), True

        def batch() -> pa.RecordBatch:
            ids = pa.array(convs, pa_kind)
            return pa.RecordBatch.from_arrays([ids, pa.array(found, pa.string())], ["conv", "repaired_sha256"])

        for what, conv, turn in _walked(batches):
            if what == "turn":
                _, role, text = turn
                digest.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False
                continue
            convs.append(conv)
            found.append(digest.hexdigest())
            digest, first = hashlib.sha256(), True
            if len(convs) == 1000:
                yield batch()
                convs.clear()
                found.clear()
        yield batch()

    pa_kind = _arrow_type(kind)
    return _along(ordered, parses).mapInArrow(run, f"conv {kind.simpleString()}, repaired_sha256 string")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def turns(ordered: DataFrame, parses: DataFrame) -> DataFrame:
    """(conv, turn, edit, role, text): the repaired turns, numbered from 0."""
    kind = ordered.schema["conv"].dataType
    pa_kind = _arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n, chars = [], 0, 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            kinds = [pa_kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["conv", "turn", "edit", "role", "text"])

        for what, conv, turn in _walked(batches):
            if what == "end":
                n = 0
                continue
            rows.append((conv, n, *turn))
            n, chars = n + 1, chars + len(turn[2])
            if len(rows) == 1000 or chars > 1 << 20:
                yield batch()
                rows.clear()
                chars = 0
        yield batch()

    schema = f"conv {kind.simpleString()}, turn bigint, edit string, role string, text string"
    return _along(ordered, parses).mapInArrow(run, schema)


@dataclass(frozen=True)
class Repair:
    """Sorted rows and the parse of every conversation, both written."""

    ordered: DataFrame
    parses: DataFrame
    gaps: DataFrame

    def turns(self) -> DataFrame:
        return turns(self.ordered, self.parses)

    def digests(self) -> DataFrame:
        return digests(self.ordered, self.parses)


def repair(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    costs: Costs | None = None,
) -> Repair:
    """Find the cheapest repair of every conversation of ``df``.

    Rows are taken by turn, null turns first; rows of one turn by role, the
    first 64 characters of their text and its digest. A null role or text is one
    blank; rows of a null conversation are a conversation. A blank row has no
    character but white space, a duplicate repeats role and text of an earlier
    row, a truncated one does not end in ``.``, ``!`` or ``?``; the first of these
    counts. Blank and duplicate rows have to be deleted. Gaps are counted up to
    2**63 - 1. Texts of any length and
    repeated rows are fine; an empty table has no conversations. Other columns
    are ignored, whatever their names.
    """
    ordered = in_order(df, conversation, turn, role, text)
    faulty = stored(with_faults(ordered), "faults")
    parses = stored(parsed(faulty, costs or Costs()), "parses")
    # Turns once each, so that the second grouping has few rows a conversation left to add up.
    distinct = faulty.select("conv", "turn").distinct()
    wide = [F.max("turn").cast("decimal(20)"), F.min("turn").cast("decimal(20)")]
    span = wide[0] - wide[1] + 1 - F.count("turn")
    most = F.lit(2**63 - 1).cast("decimal(23)")
    gaps = F.least(F.coalesce(span, F.lit(0)), most).cast("bigint").alias("gaps")
    gaps = distinct.groupBy("conv").agg(gaps)
    return Repair(ordered, parses, gaps)


def damaged(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``df`` with faults put in by the hash of conversation and turn; for trials of the repair.

    Of 20 equal parts one loses its rows, one their texts, one their sentence
    ends, one has every row twice, and one has only users. Null values count as
    one blank, in the hash too; a null turn stays null.
    """
    blank = F.lit(" ")
    shown = [F.coalesce(F.col(name).cast("string"), blank) for name in (conversation, turn)]
    part = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    rows = df.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("_role"),
        F.col(text).alias("_text"),
        part.alias("_part"),
    )
    value = F.coalesce("_text", blank)
    changed = F.when(F.col("_part") == 1, "").when(F.col("_part") == 2, F.translate(value, ".!?", ""))
    copies = F.when(F.col("_part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("_part <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_part") == 4, "user").otherwise(F.coalesce("_role", blank)).alias("role"),
        changed.otherwise(value).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def summary(df: DataFrame, repaired: Repair, conversation: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``df``: its gaps, faults, cost, audit and repaired digest.

    A conversation without rows in the repair has zeros, an empty audit and the
    digest of nothing. A null conversation is one.
    """
    known = repaired.parses.join(
        repaired.gaps.withColumnRenamed("conv", "g"), F.col("conv").eqNullSafe(F.col("g")), "left"
    )
    known = known.join(
        repaired.digests().withColumnRenamed("conv", "d"), F.col("conv").eqNullSafe(F.col("d")), "left"
    )
    ids = df.select(F.col(conversation).alias(conversation)).distinct()
    found = ids.join(known, F.col(conversation).eqNullSafe(F.col("conv")), "left")
    zero = F.lit(0).cast("bigint")
    return found.select(
        conversation,
        *[F.coalesce(name, zero).alias(name) for name in ("gaps", *COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
