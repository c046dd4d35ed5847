"""Repair of conversation structure by the cheapest edits.

A repaired conversation has, after at most one system turn at its start, one or more
pairs of a user and an assistant turn, or no turns at all.  Rows that are blank or
repeat an earlier row go; ``blocks`` finds the cheapest edits of the rest.

A conversation of any length is spread: light rows (without their text) are sorted
over all tasks by range, cut into pieces of at most ``PIECE`` rows, and every piece is
reduced to what it does in whatever surroundings (``blocks.summary``).  Only those
summaries of a conversation meet, which tells each piece what stands left and
right of it; then pieces are traced independently.  Texts are shuffled once, to
stand beside their edits in the order of their conversation, and pass through as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import blocks
from tidelog.llm.base import small_batches, stage

PIECE = 4096
#: Pieces a task unpacks, and rows it hands on, at a time.
IN_PIECES, OUT_ROWS = 32, 500
# Characters that leave a text blank, and those that end a sentence.
BLANK = r"^[\x20\x09-\x0D]*$"
CUT_OFF = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$"
OK, EMPTY, REPEATED, TRUNCATED = range(4)
FAULTS = ("", "blank", "duplicate", "truncated")

EDITS = ("place long, turn long, edit string, fault string, old_role string, role string, text string, times long")


def turns_of(turns: DataFrame) -> DataFrame:
    """The four columns used; a null role or text is one space."""
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """Damage one row in four, by a checksum of ``conv_id:turn``: 0 of 20 drops the row,
    1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes its role user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    rows = turns_of(turns).withColumn("_kind", kind).filter("_kind <> 0")
    return rows.select("conv_id", "turn", F.when(F.col("_kind") == 4, blocks.USER).otherwise(F.col("role")).alias("role"),
                       text.alias("text"),
                       F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
                       ).drop("_copy")


def _digest(*columns: str) -> Column:
    """SHA-256 of columns; lengths in front keep them apart."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    heads = [F.when(F.col(c).isNull(), "-").otherwise(F.char_length(t).cast("string"))
             for c, t in zip(columns, texts, strict=True)]
    return F.unhex(F.sha2(F.concat_ws("\n", *heads, *texts), 256))


def light_rows(turns: DataFrame) -> DataFrame:
    """Without texts: one row per different row of a conversation, with its fault.

    Equal rows of a turn are counted before anything is shuffled.  A row repeats
    an earlier one if its role and text occur in a smaller turn; the smallest turn
    comes from a partial aggregate, and only rows that occur in several turns take part in the join.
    """
    rows = (turns_of(turns).withColumn("key", _digest("text")).withColumn("same", _digest("conv_id", "role", "text"))
            .groupBy("conv_id", "turn", "role", "key", "same")
            .agg(F.count("*").alias("copies"), F.first(F.col("text").rlike(BLANK)).alias("blank"),
                 F.first(F.col("text").rlike(CUT_OFF)).alias("cut_off")))
    rows = stage(rows, "repair-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (rows.groupBy("same").agg(F.min(order).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("same", "first"))
    joined = rows.join(first, "same", "left")
    fault = (F.when(F.col("blank"), EMPTY).when(F.col("first").isNotNull() & (F.col("first") != order), REPEATED)
             .when(F.col("cut_off"), TRUNCATED).otherwise(OK))
    return joined.select("conv_id", "turn", "role", "key", "copies", fault.alias("fault"))


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[dict, bool]]:
    """Rows of sorted batches, with the value of ``key`` and whether it is a new one."""
    last, started = None, False
    for batch in batches:
        for row in batch.to_pylist():
            new = not started or row[key] != last
            last, started = row[key], True
            yield row, new


def _out(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Light rows in order, in pieces: ``(conv_id, part, seq, rows, left, ends)``.

    Staged, as the parts of a range partitioning are only the same once written.
    """
    # Turns that are null come first.
    order = ["conv_id", "turn", "role", "key"]
    spread = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("part"), *order, "copies", "fault"))
    fields = "array<struct<turn:bigint,role:string,key:binary,copies:bigint,fault:int>>"
    kind = rows.schema["conv_id"].dataType.simpleString()
    shape = f"conv_id {kind}, part int, seq long, rows {fields}, left binary, ends binary"
    schema = _arrow(rows.sparkSession.createDataFrame([], shape).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seq, piece, conv, part = [], 0, [], None, None

        def closed() -> dict:
            left, ends = blocks.summary(_symbols(piece))
            return {"conv_id": conv, "part": part, "seq": seq, "rows": piece,
                    "left": left.astype(np.int16).tobytes(), "ends": ends.astype(np.int8).tobytes()}
        for row, new in _runs(batches, "conv_id"):
            if piece and (new or len(piece) == size):
                held.append(closed())
                seq, piece = seq + 1, []
                if sum(len(h["rows"]) for h in held) >= OUT_ROWS:
                    yield _out(held, schema)
                    held = []
            conv, part = row.pop("conv_id"), row.pop("part")
            piece.append(row)
        if piece:
            held.append(closed())
        if held:
            yield _out(held, schema)

    return stage(spread.mapInArrow(run, shape), "repair-pieces")


def _symbols(piece: list[dict]) -> list[int]:
    """Symbols of the rows that may stay; the others leave every state as it is."""
    return [blocks.symbol(r["role"][:1], r["fault"] == TRUNCATED) for r in piece if r["fault"] in (OK, TRUNCATED)]


def places(found: DataFrame) -> DataFrame:
    """For each piece the state before it and the vector after it, from the summaries of its conversation."""
    shape = "part int, seq long, state int, vector int, last boolean"
    schema = _arrow(found.sparkSession.createDataFrame([], shape).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own = [], []

        def placed() -> Iterator[dict]:
            vector, right = blocks.tables().final, []
            for p in reversed(own):
                right.append(vector)
                vector = int(np.frombuffer(p["left"], np.int16)[vector])
            state = blocks.START
            for p, v in zip(own, reversed(right), strict=True):
                yield {"part": p["part"], "seq": p["seq"], "state": state, "vector": v, "last": p is own[-1]}
                state = int(np.frombuffer(p["ends"], np.int8).reshape(-1, blocks.STATES)[v, state])
        for row, new in _runs(batches, "conv_id"):
            if new and own:
                out.extend(placed())
                own = []
                if len(out) >= OUT_ROWS:
                    yield _out(out, schema)
                    out = []
            own.append(row)
        if own:
            out.extend(placed())
        if out:
            yield _out(out, schema)

    light = found.select("conv_id", "part", "seq", "left", "ends")
    return light.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, shape)


def _traced(found: DataFrame) -> DataFrame:
    """The edits of every light row: letters, the roles written before it, its own and, at the end, after it."""
    kind = found.schema["conv_id"].dataType.simpleString()
    shape = (f"conv_id {kind}, turn long, role string, key binary, copies long, fault int, edit string, "
             "before array<string>, new_role string, after array<string>")
    schema = _arrow(found.sparkSession.createDataFrame([], shape).schema)

    def traced(piece: dict) -> list[dict]:
        letters, end = blocks.trace(_symbols(piece["rows"]), piece["state"], piece["vector"])
        state, left, out = piece["state"], iter(letters), []
        for r in piece["rows"]:
            r |= {"conv_id": piece["conv_id"], "edit": "D", "before": [], "new_role": None, "after": []}
            if r["fault"] in (OK, TRUNCATED):
                edits = next(left)
                for _ in edits[:-1]:
                    r["before"].append(blocks.WRITES[state])
                    state = blocks.NEXT[state]
                r["edit"] = edits[-1]
                if edits[-1] == "R":
                    r["new_role"], state = blocks.WRITES[state], blocks.NEXT[state]
                elif edits[-1] == "K":
                    r["new_role"], state = r["role"], blocks.kept_state(state, blocks.symbol(r["role"][:1], False))
            out.append(r)
        assert state == end
        if piece["last"]:
            for _ in blocks.last_edits(state):
                out[-1]["after"].append(blocks.WRITES[state])
                state = blocks.NEXT[state]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for batch in batches:
            # Many short pieces or a few long ones at a time.
            for at in range(0, batch.num_rows, IN_PIECES):
                for piece in batch.slice(at, IN_PIECES).to_pylist():
                    out.extend(traced(piece))
                    if len(out) >= OUT_ROWS:
                        yield _out(out, schema)
                        out = []
        if out:
            yield _out(out, schema)

    return found.join(places(found), ["part", "seq"]).select(
        "conv_id", "rows", "state", "vector", "last").mapInArrow(run, shape)


def repair(turns: DataFrame, size: int = PIECE) -> DataFrame:
    """The cheapest edits that bring every conversation into structure.

    ``turns`` needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    ignored, whatever their names.  Rows are taken by turn, null turns first; rows of one
    turn by role, then by a digest of the text.  A null role or text is one space, a
    null ``conv_id`` is a conversation like any other, and a role is known by its
    first letter: one without any fits nowhere.  The first fault of a row counts: ``blank``,
    ``duplicate`` (role and text seen earlier in the conversation), ``truncated``.  Keeping costs 0,
    a new role 2, deleting 3 (and has to be for blanks and duplicates), inserting an
    empty turn 2; a truncated row that stays adds 1.  Of equally cheap edits those come
    whose letters D, I, K, R are the least string.

    Result: ``conv_id``, ``place`` (from 0), ``turn``, ``edit``, ``fault``, ``old_role`` (null
    for inserts), ``role`` and ``text`` (null where deleted), ``times``: a run of equal
    rows that go is one row.  The rows of a conversation stand in one partition, in order of
    ``place``.  Conversations without rows, and empty tables, give none.
    """
    small_batches(turns.sparkSession)
    rows = turns_of(turns)
    found = pieces(light_rows(rows), size)
    edits = _traced(found)
    kind = found.schema["conv_id"].dataType.simpleString()
    none = {c: F.lit(None).cast(t) for c, t in edits.dtypes}
    texts = rows.select("conv_id", "turn", "role", _digest("text").alias("key"),
                        *[none[c].alias(c) for c in edits.columns[4:]], "text", F.lit(1).alias("kind"))
    both = edits.select("*", F.lit(None).cast("string").alias("text"), F.lit(0).alias("kind")).unionByName(texts)
    order = ["conv_id", "turn", "role", "key", "kind"]
    shape = f"conv_id {kind}, {EDITS}"
    schema = _arrow(turns.sparkSession.createDataFrame([], shape).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, volume, place, edit = [], 0, 0, None

        def line(**values) -> dict:
            return {"conv_id": edit["conv_id"], "place": place, "turn": None, "fault": "", "old_role": None,
                    "role": None, "text": None, "times": 1, **values}
        for row, new in _runs(batches, "conv_id"):
            if new:
                place = 0
            if row["kind"] == 0:
                edit = row
                continue
            if edit is None:
                continue  # a copy of the row before, counted in its ``copies``
            fault = FAULTS[edit["fault"]]
            own = {"turn": edit["turn"], "old_role": edit["role"]}
            for role in edit["before"]:
                out.append(line(edit="I", role=role, text=""))
                place += 1
            gone = edit["copies"]
            if edit["edit"] != "D":
                out.append(line(**own, edit=edit["edit"], fault=fault, role=edit["new_role"], text=row["text"]))
                place, gone, fault = place + 1, gone - 1, FAULTS[REPEATED]
            elif edit["fault"] in (OK, TRUNCATED):
                out.append(line(**own, edit="D", fault=fault))
                place, gone, fault = place + 1, gone - 1, FAULTS[REPEATED]
            if gone:
                out.append(line(**own, edit="D", fault=fault, times=gone))
                place += gone
            for role in edit["after"]:
                out.append(line(edit="I", role=role, text=""))
                place += 1
            volume += len(row["text"])
            edit = None
            if len(out) >= OUT_ROWS or volume > 1 << 20:
                yield _out(out, schema)
                out, volume = [], 0
        if out:
            yield _out(out, schema)

    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, shape)


def reports(edits: DataFrame) -> DataFrame:
    """What was found and done in each conversation, from :func:`repair`.

    ``conv_id``, ``gaps`` (turns missing between the least and the greatest), ``blank``, ``duplicate``,
    ``truncated`` (rows), ``illegal`` (neighbouring roles that may not follow each
    other), ``cost``, ``audit`` (a letter per edit) and ``repaired_sha256`` of the lines
    ``role:text``.  Rows pass in order as a stream; what is held of a conversation is its letters.
    """
    import hashlib
    kind = edits.schema["conv_id"].dataType.simpleString()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    shape = f"conv_id {kind}, {', '.join(f'{c} long' for c in numbers)}, audit string, repaired_sha256 string"
    schema = _arrow(edits.sparkSession.createDataFrame([], shape).schema)
    price = {"D": blocks.DELETE, "I": blocks.INSERT, "R": blocks.REROLE, "K": 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, one = [], None

        def closed() -> dict:
            gaps = one["greatest"] - one["least"] + 1 - one["turns"] if one["turns"] else 0
            return {"conv_id": one["conv_id"], "gaps": gaps, "audit": "".join(one["audit"]),
                    "repaired_sha256": one["hash"].hexdigest(), **{c: one[c] for c in numbers[1:]}}
        for row, new in _runs(batches, "conv_id"):
            if new:
                if one:
                    out.append(closed())
                    if len(out) >= OUT_ROWS:
                        yield _out(out, schema)
                        out = []
                one = {"conv_id": row["conv_id"], "least": None, "greatest": None, "turns": 0, "audit": [],
                       "hash": hashlib.sha256(), "kept": 0, "initial": None, **dict.fromkeys(numbers, 0)}
            times, edit = row["times"], row["edit"]
            one["audit"].append(edit * times)
            one["cost"] += price[edit] * times + (blocks.CUT_OFF if edit in "KR" and row["fault"] == "truncated" else 0)
            if row["fault"]:
                one[row["fault"]] += times
            if edit != "I":
                initial = row["old_role"][:1]
                if one["initial"] is not None:
                    one["illegal"] += one["initial"] + initial not in ("su", "ua", "au")
                one["illegal"] += times - 1
                one["initial"] = initial
                if row["turn"] is not None and row["turn"] != one["greatest"]:
                    one["turns"] += 1
                    one["greatest"] = row["turn"]
                    one["least"] = row["turn"] if one["least"] is None else one["least"]
            if edit != "D":
                one["hash"].update((("\n" if one["kept"] else "") + row["role"] + ":" + row["text"]).encode())
                one["kept"] += 1
        if one:
            out.append(closed())
        if out:
            yield _out(out, schema)

    return edits.mapInArrow(run, shape)
