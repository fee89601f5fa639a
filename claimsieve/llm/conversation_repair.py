"""Cheapest repair of the turn structure of conversations, by weighted interval parsing.

The initials of a repaired conversation's roles read (s?(ua)+)?: an optional system turn, then pairs
of user and assistant, or nothing. Rows are kept, given the other role, deleted or inserted, at a cost.
The grammar is in Chomsky normal form: symbol pq derives what leads from place p of that pattern to
place q, pq -> pr rq, and pq -> one edited row. A cell of the chart holds, for a span of rows and each
pq, the least (cost, audit), closed under insertions before and after its rows; the chart fills by
rising span length over all splits. Audits of one span, pq and cost are never prefixes of each other,
so the least audits of two parts give the least of both.

All splits of a span give the same cell in this grammar. So the chart need not be one triangle for a
long conversation: blocks of ``BLOCK`` rows are parsed to one cell each, blocks of those cells to the
next, until one is left, and work grows with the number of rows.

Rows are sorted over all tasks by conversation and turn, so a conversation of any length lies in as
many tasks as it needs. What begins and ends inside a task is finished there. What may cross into
another is cut into chunks with a cell each; their cells are joined per conversation, and each chunk
learns its part of the audit. Only the hash over a conversation's whole text is taken in one
task, chunk by chunk.

Rows of one turn go by role, then text. Equal rows are one row with a number, so repeats cost
nothing. Defined results: NULL and blank texts are blank; NULL turns come first and make no gap; a NULL or empty
role, or one whose initial is no s, u or a, is never kept as it is; a NULL conversation id is a
conversation; a conversation without rows has zeros, no audit and the hash of nothing; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import SLICE_BYTES, bounded, columns_of, stored, unused

# What edits cost, and what a truncated row that stays costs besides.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 3, 4, 3, 3
#: Places in the pattern: nothing yet, after the system turn, after a user turn, after a whole pair.
BEGIN, SYSTEM, USER, PAIR = range(4)
STEPS = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
#: Rows, or cells of rows, that one triangle of the chart spans; rows of a chunk of a conversation that crosses tasks.
BLOCK, CHUNK = 16, 2000
COPIES = "copies"

Cell = dict[tuple[int, int], tuple[int, str]]


def _best(cell: Cell, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cell or value < cell[key]:
        cell[key] = value


def _into(cell: Cell, left: Cell, right: Cell) -> None:
    """pq -> pr rq: what ``left`` and ``right`` derive one after the other, where it is better than what the cell has."""
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if (r, q) in right:
                _best(cell, (p, q), (cost + right[r, q][0], audit + right[r, q][1]))


def _insertions() -> Cell:
    """The cell of no rows: any place is kept for nothing, or left by inserted turns."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    inserted = {(p, q): (INSERT, "I") for (p, role), q in STEPS.items() if role in ROLES}
    for _ in range(4):
        longer: Cell = dict(cell)
        _into(longer, cell, inserted)
        cell = longer
    return cell


NOTHING = _insertions()


@lru_cache(maxsize=None)
def row_cell(symbol: str) -> Cell:
    """One row, closed under insertions: its role's initial in lower case if the row is whole, in upper case if
    truncated; 'x' or 'X' for another role; '-' for a row that must go."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if symbol != "-":
        stays = TRUNCATED_STAYS if symbol.isupper() else 0
        for (p, role), q in STEPS.items():
            if role == symbol.lower():
                _best(cell, (p, q), (KEEP + stays, "K"))
            if role in ROLES:
                _best(cell, (p, q), (REROLE + stays, "R"))
    before: Cell = {}
    _into(before, NOTHING, cell)
    closed: Cell = {}
    _into(closed, before, NOTHING)
    return closed


def chart(cells: list[Cell]) -> Cell:
    """The cell of the whole span, from those of all shorter spans and all their splits."""
    n = len(cells)
    spans = {(i, i + 1): cell for i, cell in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for k in range(i + 1, i + length):
                _into(cell, spans[i, k], spans[k, i + length])
            spans[i, i + length] = cell
    return spans[0, n] if n else NOTHING


@lru_cache(maxsize=20_000)
def _block(symbols: str) -> Cell:
    return chart([row_cell(x) for x in symbols])


def parse(symbols: str) -> Cell:
    """The cell of a run of rows, one letter each."""
    cells = [_block(symbols[i : i + BLOCK]) for i in range(0, len(symbols), BLOCK)]
    while len(cells) > 1:
        cells = [chart(cells[i : i + BLOCK]) for i in range(0, len(cells), BLOCK)]
    return cells[0] if cells else NOTHING


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation: nothing, or any number of whole pairs."""
    return min(cell[BEGIN, q] for q in (BEGIN, PAIR) if (BEGIN, q) in cell)


def repaired(audit: str, roles: list[str | None], texts: list[str | None], place: int = BEGIN) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn that an audit leaves, from a place of the pattern on."""
    rows = iter(zip(roles, texts))
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if place == USER else "u"]
        place = STEPS[place, role[0]]
        yield role, text or ""


@dataclass
class Piece:
    """What is known of a run of sorted rows of one conversation."""

    symbols: list[str] = field(default_factory=list)
    roles: list[str | None] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    size: int = 0
    low: int | None = None
    high: int | None = None
    turns: int = 0
    faults: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def add(self, turn: int | None, role: str | None, text: str | None, n: int, fault: str | None) -> None:
        """``n`` equal rows; those after the first have been seen, and are held as deletions without a text."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = (role or "")[:1]
        letter = initial if initial in ("s", "u", "a") else "x"
        for i in range(n):
            what = "duplicate" if i and fault != "blank" else fault
            if what:
                self.faults[what] += 1
            gone = what in ("blank", "duplicate")
            self.symbols.append("-" if gone else letter.upper() if what else letter)
            self.roles.append(None if gone else role)
            self.texts.append(None if gone else text)
            self.size += 0 if gone else len(text or "") + 8
            self.illegal += self.last is not None and not legal(self.last, initial)
            self.first, self.last = initial if self.first is None else self.first, initial

    def known(self) -> dict:
        return {
            "low": self.low, "high": self.high, "turns": self.turns, **self.faults, "illegal": self.illegal,
            "first": self.first, "last": self.last,
        }


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _result(known: dict, cost: int, audit: str, digest: str) -> dict:
    gaps = known["high"] - known["low"] + 1 - known["turns"] if known["turns"] else 0
    counts = {k: known[k] for k in ("blank", "duplicate", "truncated", "illegal")}
    return {"gaps": gaps, **counts, "cost": cost, "audit": audit, "repaired_sha256": digest}


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PIECES = (
    "low long, high long, turns long, first string, last string, task int, chunk int, symbols string, "
    "roles array<string>, texts array<string>"
)


def _lines(turns: Iterator[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in turns).encode()


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Different rows by conversation and turn, with their number and the first one's fault.

    A row with number 0 only names its conversation.
    """
    there = F.col("copies") > 0
    named = [F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")]
    different = rows.select("conv_id", *named, "copies").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    solid = F.rtrim(F.col("text"), F.lit("\x20\x09\x0a\x0b\x0c\x0d"))
    judged = different.select(
        "conv_id", "turn", "role", "text", "n", F.sha2("text", 256).alias("digest"),
        F.coalesce(F.length(solid) == 0, F.lit(True)).alias("blank"),
        (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    told = judged.where("NOT blank").groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("rows"))
    told = stored(told.where("rows > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "first"), "told")
    same = [judged[c].eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role")] + [judged["digest"] == F.col("_digest")]
    fault = (
        F.when(F.col("blank"), "blank").when(F.coalesce(when > F.col("first"), F.lit(False)), "duplicate").when(F.col("cut"), "truncated")
    )
    flagged = judged.join(bounded(told), same, "left").select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))
    return flagged.orderBy("conv_id", F.col("n") > 0, "turn", "role", "text")


def _parse_runs(id_type: str):
    """Results of the conversations that lie within a task, and chunks of its first and last one."""
    schema = f"conv_id {id_type}, {RESULT}, {_PIECES}"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"symbols": pa.string(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "task": pa.int32(), "chunk": pa.int32()}
    kinds |= dict.fromkeys(("audit", "repaired_sha256", "first", "last"), pa.string())

    def batch(found: list[dict], id_kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array([x.get(c) for x in found], id_kind if c == "conv_id" else kinds.get(c, pa.int64())) for c in names]
        return pa.RecordBatch.from_arrays(columns, names)

    def chunk(conv, piece: Piece, at: int) -> dict:
        row = {"conv_id": conv, "task": TaskContext.get().partitionId(), "chunk": at, "symbols": "".join(piece.symbols)}
        return row | piece.known() | {"roles": piece.roles, "texts": piece.texts}

    def whole(conv, piece: Piece) -> dict:
        cost, audit = cheapest(parse("".join(piece.symbols)))
        digest = hashlib.sha256(_lines(repaired(audit, piece.roles, piece.texts))).hexdigest()
        return {"conv_id": conv} | _result(piece.known(), cost, audit, digest)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, piece, at, first, kind, found = None, None, 0, True, None, []
        for part in batches:
            kind = part.column("conv_id").type
            for new, turn, role, text, n, fault in zip(*(part.column(i).to_pylist() for i in range(6))):
                if piece is None:
                    conv, piece = new, Piece()
                elif new != conv:
                    found.append(chunk(conv, piece, at) if first or at else whole(conv, piece))
                    conv, piece, at, first = new, Piece(), 0, False
                elif len(piece.symbols) >= CHUNK or piece.size > SLICE_BYTES:
                    found.append(chunk(conv, piece, at))
                    piece, at = Piece(), at + 1
                left = int(n)
                while left > CHUNK:  # a row that repeats very often
                    piece.add(turn, role, text, CHUNK, fault)
                    found.append(chunk(conv, piece, at))
                    piece, at, left, fault = Piece(), at + 1, left - CHUNK, fault if fault == "blank" else "duplicate"
                piece.add(turn, role, text, left, fault)
                if len(found) >= 500 or found and found[-1].get("chunk") is not None:
                    yield batch(found, kind)
                    found = []
        if piece is not None:
            found.append(chunk(conv, piece, at))
        if found:
            yield batch(found, kind)

    return task, schema


def _join_cells(id_type: str):
    """The result of a conversation from its chunks, and each chunk's part of the audit with the place it begins at."""
    schema = f"conv_id {id_type}, {RESULT}, task int, chunk int, part string, place int"

    def join(table: pa.Table) -> pa.Table:
        chunks = sorted(table.to_pylist(), key=lambda x: (x["task"], x["chunk"]))
        paths = {BEGIN: (0, "", ())}
        for x in chunks:
            cell, longer = parse(x["symbols"]), {}
            for p, (cost, audit, places) in paths.items():
                for q in range(4):
                    if (p, q) in cell:
                        more = (cost + cell[p, q][0], audit + cell[p, q][1], (*places, (p, cell[p, q][1])))
                        longer[q] = min(longer.get(q, more), more)
            paths = longer
        cost, audit, parts = min(paths[q] for q in (BEGIN, PAIR) if q in paths)
        turns = sum(x["turns"] for x in chunks)
        timed = [x for x in chunks if x["turns"]]
        turns -= sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        known = {"low": timed[0]["low"], "high": timed[-1]["high"]} if timed else {"low": None, "high": None}
        known |= {k: sum(x[k] for x in chunks) for k in ("blank", "duplicate", "truncated", "illegal")} | {"turns": turns}
        told = [x for x in chunks if x["first"] is not None]
        known["illegal"] += sum(not legal(a["last"], b["first"]) for a, b in zip(told, told[1:]))
        result = _result(known, cost, audit, None)
        empty = dict.fromkeys(result)
        rows = [
            {"conv_id": x["conv_id"], **(empty if i else result), "task": x["task"], "chunk": x["chunk"], "part": part, "place": p}
            for i, (x, (p, part)) in enumerate(zip(chunks, parts))
        ]
        texts = ("audit", "repaired_sha256", "part")
        kinds = {"conv_id": table.schema.field("conv_id").type, "task": pa.int32(), "chunk": pa.int32(), "place": pa.int32()}
        kinds |= dict.fromkeys(texts, pa.string())
        return pa.table({c: pa.array([r[c] for r in rows], kinds.get(c, pa.int64())) for c in (c.split()[0] for c in schema.split(", "))})

    return join, schema


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every conversation's repaired text, from its sorted chunks one after the other."""
    conv, digest, begun, kind = None, None, False, None
    for part in batches:
        kind = part.column("conv_id").type
        for x in part.to_pylist():
            if digest is None or x["conv_id"] != conv:
                if digest is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], ["conv_id", "digest"])
                conv, digest, begun = x["conv_id"], hashlib.sha256(), False
            turns = list(repaired(x["part"], x["roles"], x["texts"], x["place"]))
            digest.update((b"\n" if begun and turns else b"") + _lines(iter(turns)))
            begun = begun or bool(turns)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], ["conv_id", "digest"])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies_col: str | None = None) -> DataFrame:
    """conv_id, gaps, faults by kind, illegal neighbours, cost, audit and the hash of the repaired text of every conversation.

    ``copies_col`` says how often a row stands there; one with 0 only names its conversation.
    """
    named = columns_of(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col, copies=copies_col or f"?{COPIES}")
    named = named.withColumn("copies", F.col("copies").cast("long") if copies_col else F.lit(1).cast("long"))
    id_type = named.schema["conv_id"].dataType.simpleString()
    task, schema = _parse_runs(id_type)
    found = stored(_sorted_rows(named).mapInArrow(task, schema), "runs")
    crossing = found.where("chunk IS NOT NULL")
    join, join_schema = _join_cells(id_type)
    light = crossing.select("conv_id", "low", "high", "turns", "first", "last", "blank", "duplicate", "truncated", "illegal",
                            "task", "chunk", "symbols")
    parts = stored(light.groupBy("conv_id").applyInArrow(join, join_schema), "parts")
    texts = crossing.select(F.col("conv_id").alias("_id"), F.col("task").alias("_task"), F.col("chunk").alias("_chunk"), "roles", "texts")
    same = [F.col("conv_id").eqNullSafe(F.col("_id")), F.col("task") == F.col("_task"), F.col("chunk") == F.col("_chunk")]
    lines = parts.join(texts, same).select("conv_id", "task", "chunk", "part", "place", "roles", "texts")
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "task", "chunk")
    hashed = lines.mapInArrow(_hash_chunks, f"conv_id {id_type}, digest string").withColumnRenamed("conv_id", "_id")
    names = [c.split()[0] for c in RESULT.split(", ")]
    joined = parts.where("cost IS NOT NULL").join(hashed, F.col("conv_id").eqNullSafe(F.col("_id")))
    joined = joined.withColumn("repaired_sha256", F.col("digest")).select("conv_id", *names)
    return found.where("chunk IS NULL").select("conv_id", *names).unionByName(joined)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with faults by a hash of their conversation and turn, and a column with the number of copies.

    Of twenty hash classes one drops the row (0 copies), one empties its text, one removes its full
    stops, one stands there twice and one gets the user's role.
    """
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1])) % 20
    text, role = F.col(text_col), F.col(role_col)
    return rows.withColumns(
        {
            text_col: F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text),
            role_col: F.when(kind == 4, "user").otherwise(role),
            unused(rows.columns, COPIES)[0]: F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1),
        }
    )
