"""Repair of conversations whose rows were lost, emptied, cut off, repeated or given a wrong role.

A repaired conversation is empty, or pairs of user and assistant rows after at most one system row.
Rows are kept, given another role, deleted, or inserted without text, at the least cost; of equally
cheap repairs the one whose edits come first in ASCII order is taken (``alignment``).

Rows travel without their text, as a digest. Conversations are sorted by ranges over all tasks and
cut into segments of at most ``SEGMENT`` rows, so that one conversation may hold most of the table: a
segment says what it costs from each state to each other one, a conversation joins these summaries,
and each segment is then solved alone between the two states found for it. Texts are joined to the
rows that stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm import alignment
from trendloom.llm.common import picked, prepare, stored

# Most rows of a segment, unless one row is repeated more often.
SEGMENT = 1 << 15
# Segments that are handed on at once, as rows of them.
BATCH_ROWS = 1 << 15

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
DIGEST_OF_NOTHING = hashlib.sha256(b"").hexdigest()


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The drill: a twentieth each of the rows is dropped, emptied, left without sentence ends, repeated, or made a user's.

    Which rows is decided by the checksum of conversation and turn; null values there, and null roles
    and texts, are one space. Result: ``conv_id``, ``turn``, ``role``, ``text``.
    """
    rows = picked(turns, conv, turn, role, text).toDF("conv_id", "turn", "role", "text")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("fate", F.crc32(key) % 20).where("fate <> 0")
    role_of, text_of = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(role_of).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(text_of, ENDS, "")).otherwise(text_of).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("again"),
    ).drop("again")


def _rows(turns: DataFrame) -> DataFrame:
    space = F.lit(" ")
    rows = picked(turns, "conv_id", "turn", "role", "text").withColumns(
        {"turn": F.col("turn").cast("long"), "role": F.coalesce(F.col("role").cast("string"), space), "text": F.coalesce(F.col("text").cast("string"), space)}
    )
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def _fault(text: Column) -> Column:
    """What is wrong with a row by its text: nothing, cut off, or blank."""
    shown = F.rtrim(text, F.lit(SPACE))
    return F.when(shown == "", alignment.GONE).when(~F.right(shown, F.lit(1)).isin(*ENDS), alignment.CUT_OFF).otherwise(alignment.FINE)


KEY = ["conv_id", "turn", "role", "digest"]


def _keyed(turns: DataFrame) -> DataFrame:
    """A row per different row of a conversation: the key, its fault, how often it stands, whether role and text stood earlier."""
    rows = _rows(turns).withColumn("fault", _fault(F.col("text"))).groupBy(*KEY, "fault").agg(F.count("*").alias("times"))
    rows = stored(rows, "turns")
    # the smallest struct has the null turn, if there is one
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "digest")], "first.turn").withColumnRenamed("turn", "f_turn")
    met = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in ("conv_id", "role", "digest")]
    return rows.join(first, met).select(*KEY, "fault", "times", (~F.col("turn").eqNullSafe(F.col("f_turn"))).alias("seen"))


class _Segment:
    """Rows of one conversation that stand together, and what a conversation needs to know of them."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.turns, self.roles, self.digests, self.times, self.codes = [], [], [], [], bytearray()
        self.n_rows = self.illegal = self.blank = self.duplicate = self.truncated = self.n_turns = 0

    def add(self, turn: int | None, role: str, digest: bytes, fault: int, times: int, seen: bool) -> None:
        own = alignment.code(role[:1], alignment.GONE if seen else fault)
        if self.n_rows:
            self.illegal += _illegal(self.codes[-1], own)
        again = alignment.code(role[:1], alignment.GONE)
        self.illegal += (times - 1) * _illegal(again, again)
        if fault == alignment.GONE:
            self.blank += times
        elif seen:
            self.duplicate += times
        else:
            self.truncated += fault == alignment.CUT_OFF
            self.duplicate += times - 1
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.n_turns += 1
        self.n_rows += times
        self.turns.append(turn)
        self.roles.append(role)
        self.digests.append(digest)
        self.times.append(times)
        self.codes.append(own)

    def row(self, number: int) -> dict:
        known = [t for t in (self.turns[0], self.turns[-1]) if t is not None]
        if self.turns[0] is None and known:  # null turns come first
            known = [next(t for t in self.turns if t is not None), *known]
        return {
            "conv_id": self.conv,
            "segment": number,
            **{k: getattr(self, k) for k in ("turns", "roles", "digests", "times")},
            "codes": bytes(self.codes),
            "summary": alignment.summary(list(_all_rows(self.codes, self.times))),
            **{k: getattr(self, k) for k in ("blank", "duplicate", "truncated", "illegal", "n_turns")},
            "low_turn": min(known, default=None),
            "high_turn": max(known, default=None),
            "first_code": self.codes[0],
            "last_code": self.codes[-1],
        }


def _illegal(before: int, after: int) -> bool:
    """Whether two neighbours are not system and user, user and assistant, or assistant and user."""
    return (before % 4, after % 4) not in ((0, 1), (1, 2), (2, 1))


def _all_rows(codes: bytes, times: list[int]) -> Iterator[int]:
    """Codes of all rows; whatever stands again right after itself has to go."""
    for own, n in zip(codes, times, strict=True):
        yield own
        for _ in range(n - 1):
            yield alignment.code(alignment.INITIALS[own % 4 : own % 4 + 1], alignment.GONE)


def _arrow(schema: str) -> pa.Schema:
    """The Arrow schema of a result, from one line per field."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


SEGMENTS = (
    "segment long, turns array<long>, roles array<string>, digests array<binary>, times array<long>, codes binary, summary array<long>, blank long, "
    "duplicate long, truncated long, illegal long, n_turns long, low_turn long, high_turn long, first_code int, last_code int"
)


def _segments(turns: DataFrame) -> DataFrame:
    """Conversations in order, in segments that are numbered in their order."""
    rows = _keyed(turns).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    rows = rows.select(*KEY, "fault", "times", "seen")
    spark_kind = rows.schema["conv_id"].dataType.simpleString()
    own = _arrow(SEGMENTS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_, ready, n_ready, schema = None, [], 0, None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(0), *own])
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if open_ is None or open_.conv != conv or open_.n_rows + row[4] > SEGMENT:
                    if open_ is not None:
                        ready.append(open_.row(number))
                        number, n_ready = number + 1, n_ready + open_.n_rows
                    if n_ready >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(ready, schema=schema)
                        ready, n_ready = [], 0
                    open_ = _Segment(conv)
                open_.add(*row)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([*ready, open_.row(number)], schema=schema)

    return rows.mapInArrow(cut, f"conv_id {spark_kind}, {SEGMENTS}")


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states between which each segment of a conversation is solved, from all its summaries."""
    schema = _arrow(STATES)
    group: list[dict] = []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if group and row["conv_id"] != group[0]["conv_id"]:
                out += _states(group)
                group = []
            group.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if group:
        yield pa.RecordBatch.from_pylist(_states(group), schema=schema)


STATES = "segment long, entry int, exit int, closing int, between long, shared_turns long"


def _states(group: list[dict]) -> list[dict]:
    steps = [alignment.segment_step(r["summary"]) for r in group]
    ends = alignment.crossings([*steps, alignment.CLOSE], alignment.EMPTY, alignment.EMPTY, alignment.forward, alignment.backward)
    out, state = [], alignment.EMPTY
    for at, (row, end) in enumerate(zip(group, ends, strict=False)):
        before = group[at - 1] if at else None
        out.append(
            {
                "segment": row["segment"],
                "entry": state,
                "exit": end,
                "closing": alignment.CLOSING[end] if at == len(group) - 1 else 0,
                "between": int(before is not None and _illegal(before["last_code"], row["first_code"])),
                "shared_turns": int(before is not None and row["low_turn"] is not None and before["high_turn"] == row["low_turn"]),
            }
        )
        state = end
    return out


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost, edits and remaining rows of segments."""
    names = ["conv_id", "segment", "cost", "audit", "turns_left", "own_roles", "digests_left", "new_roles"]
    for batch in batches:
        found = []
        for r in batch.select(["segment", "codes", "times", "turns", "roles", "digests", "entry", "exit", "closing"]).to_pylist():
            rows = list(_all_rows(r["codes"], r["times"]))
            places = [i for i, n in enumerate(r["times"]) for _ in range(n)]
            cost, audit, left, state = alignment.INSERT * r["closing"], [], [], r["entry"]
            for place, (price, edits, to) in zip(places, alignment.edits(rows, r["entry"], r["exit"]), strict=True):
                cost += price
                audit.append(edits)
                for edit in edits:
                    if edit != "D":
                        state = to if edit == "K" else alignment.next_role(state)
                        left.append((place if edit != "I" else None, None if edit == "K" else state))
            audit.append("I" * r["closing"])
            for _ in range(r["closing"]):
                state = alignment.next_role(state)
                left.append((None, state))
            own = [[None if p is None else r[c][p] for p, _ in left] for c in ("turns", "roles", "digests")]
            roles = ["user" if s == alignment.USER else "assistant" if s == alignment.ASSISTANT else None for _, s in left]
            found.append((r["segment"], cost, "".join(audit), *own, roles))
        if found:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.string())]
            arrays = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)


class Repair:
    """Conversations repaired at the least cost.

    Rows are taken by turn, null turns first, rows of one turn by role and then by digest of their
    text. A null role or text is one space; a null conversation is one like any other. A role is known
    by its first character, and one that doesn't begin with s, u or a can't be kept. Rows that repeat
    role and text of an earlier row, or stand more than once, are duplicates. Very long texts and long
    conversations are fine: see ``SEGMENT``. Other columns are not read.
    """

    def __init__(self, turns: DataFrame) -> None:
        prepare(turns.sparkSession)
        self.turns = turns
        self.segments = stored(_segments(turns), "segments")
        kind = self.segments.schema["conv_id"].dataType.simpleString()
        small = self.segments.select("conv_id", "segment", "summary", "first_code", "last_code", "low_turn", "high_turn")
        states = small.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(_joined_up, STATES)
        self.states = stored(states, "states")
        parts = "turns_left array<long>, own_roles array<string>, digests_left array<binary>, new_roles array<string>"
        both = self.segments.select("conv_id", "segment", "codes", "times", "turns", "roles", "digests").join(self.states, "segment")
        both = both.select("conv_id", "segment", "codes", "times", "turns", "roles", "digests", "entry", "exit", "closing")
        self.solved = stored(both.mapInArrow(_solved, f"conv_id {kind}, segment long, cost long, audit string, {parts}"), "solved")

    def report(self) -> DataFrame:
        """Per conversation with rows: gaps in its turns, rows by first fault, illegal neighbours, cost and edits."""
        rows = self.segments.drop("turns", "roles", "digests", "times", "codes", "summary").join(self.states, "segment")
        rows = rows.join(self.solved.select("segment", "cost", "audit"), "segment")
        gaps = F.max("high_turn") - F.min("low_turn") + 1 - F.sum(F.col("n_turns") - F.col("shared_turns"))
        audit = F.array_sort(F.collect_list(F.struct("segment", "audit"))).getField("audit")
        return rows.groupBy("conv_id").agg(
            F.coalesce(gaps, F.lit(0)).alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
            F.sum(F.col("illegal") + F.col("between")).alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(audit, "").alias("audit"),
        )

    def repaired(self) -> DataFrame:
        """``conv_id``, ``segment`` and ``place``, which order the rows, ``turn`` (null if inserted), ``role``, ``text``."""
        rows = self.solved.select("conv_id", "segment", F.posexplode(F.arrays_zip("turns_left", "own_roles", "digests_left", "new_roles")).alias("place", "r"))
        rows = rows.select("conv_id", "segment", "place", F.col("r.turns_left").alias("turn"), F.col("r.own_roles").alias("role"), F.col("r.digests_left").alias("digest"), "r.new_roles")
        texts = _rows(self.turns).groupBy(*KEY).agg(F.first("text").alias("text"))
        texts = texts.toDF(*[f"t_{c}" for c in KEY], "text")
        met = [F.col("role") == F.col("t_role"), F.col("digest") == F.col("t_digest"), *[F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("conv_id", "turn")]]
        rows = rows.join(texts, met, "left")
        return rows.select("conv_id", "segment", "place", "turn", F.coalesce("new_roles", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``: the hash of its ``role:text`` lines, read as a stream.

    A hash is made in one go, so all text of a conversation passes one task, but never lies there.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, schema = None, None, None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(0), pa.field("repaired_sha256", pa.string())])
            done = []
            for own, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or own != conv:
                    if state is not None:
                        done.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema=schema)

    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "place").select("conv_id", "role", "text")
    return rows.mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")


def drill(turns: DataFrame) -> DataFrame:
    """Damage conversations, repair them, and report on each one that ``turns`` has.

    One that lost all rows has zeros, no edits and the hash of nothing; an empty table has no rows.
    """
    repair = Repair(damaged(turns))
    found = repair.report().join(digests(repair.repaired()).withColumnRenamed("conv_id", "h_conv"), F.col("conv_id").eqNullSafe(F.col("h_conv")), "left")
    ids = picked(turns, "conv_id").toDF("__conv").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, F.col("__conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("__conv").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(DIGEST_OF_NOTHING)).alias("repaired_sha256"),
    )
