"""Operator 12, conversation structure repair by square-root checkpointed dynamic programming.

A conversation's rows are edited at least cost so that the role initials read ``(s?(ua)+)?``: Keep (0),
Rerole to user or assistant (3), Delete (4, the only edit of blank and repeated rows), Insert an empty
user or assistant row anywhere (3); a truncated row that stays adds 3. Of the cheapest edit
sequences the one whose initials are ASCII-least is taken.

The backward costs have four states: nothing yet, after s, after u, after a. They are stored only
at checkpoints, one in about sqrt(longest conversation) rows:

1. Narrow rows (no text) are ordered by a range exchange and cut into blocks. Each block gives, for
   each conversation in it, a segment: one byte a row and a 4 x 4 table of costs from state to state.
2. Per conversation the tables are folded from the end: the state costs behind each segment (the checkpoints).
3. Per segment the costs of its rows are recomputed from its checkpoint, and walked forward from
   each of the four states: where the walk ends, and its edits.
4. Per conversation the walks are chained from the start, which picks one of the four in each segment.
5. The texts, moved once, take their edits in order.

Steps 1 and 3 hold one block, steps 2 and 4 the segments of one conversation, so a
conversation of n rows needs about sqrt(n) in a task, however many rows it has. Step 5 streams.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import Scratch

#: Blank characters: U+0020 and U+0009..U+000D.
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
ROLES = {"u": "user", "a": "assistant"}
INITIALS = "sua"
#: Rows of a block, at least.
LEAST_BLOCK = 1024
START, S, U, A = range(4)
#: The state behind an inserted or reroled row, and its role's initial.
NEXT, NEED = (U, U, A, U), "uuau"
KEPT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (A, "u"): U, (U, "a"): A}
#: What is still to insert behind the last row.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
FINE, GONE, CUT = range(3)


def _moves() -> list:
    """For each code (initial times 3 plus fault) and state: (cost, letter, state) of Delete, Keep, Rerole."""
    out = []
    for i in range(4):
        for fault in range(3):
            rows = []
            for s in range(4):
                found = [(DELETE, "D", s)]
                if fault != GONE:
                    more = TRUNCATED if fault == CUT else 0
                    if i < 3 and (s, INITIALS[i]) in KEPT:
                        found.append((KEEP + more, "K", KEPT[s, INITIALS[i]]))
                    found.append((REROLE + more, "R", NEXT[s]))
                rows.append(found)
            out.append(rows)
    return out


MOVES = _moves()


def before(code: int, after: tuple) -> tuple:
    """The state costs before a row from those behind it."""
    base = [min(c + after[t] for c, _, t in moves) for moves in MOVES[code]]
    return tuple(min(base[s], INSERT + base[NEXT[s]], 2 * INSERT + base[NEXT[NEXT[s]]]) for s in range(4))


def costs_through(codes: bytes) -> list[int]:
    """The 4 x 4 least costs from the state before the rows to the state behind them, row by row."""
    columns = []
    for end in range(4):
        v = tuple(0 if s == end else NEVER for s in range(4))
        for code in reversed(codes):
            v = before(code, v)
        columns.append(v)
    return [min(columns[e][s], NEVER) for s in range(4) for e in range(4)]


def walk(codes: bytes, end: tuple, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits from ``state`` over the rows, and the state behind them. ``end``: the costs behind the
    rows; ``last``: they are the conversation's last."""
    costs = [end]
    for code in reversed(codes):
        costs.append(before(code, costs[-1]))
    letters = []
    for i, code in enumerate(codes):
        here, after = costs[len(codes) - i], costs[len(codes) - i - 1]
        while True:
            moves = {letter: (c + after[t], t) for c, letter, t in MOVES[code][state]}
            if moves["D"][0] != here[state] and INSERT + here[NEXT[state]] == here[state]:
                letters.append("I")
                state = NEXT[state]
                continue
            letter = next(x for x in "DKR" if x in moves and moves[x][0] == here[state])
            letters.append(letter)
            state = moves[letter][1]
            break
    if last:
        while END[state]:
            letters.append("I")
            state = NEXT[state]
    return "".join(letters), state


def narrow(rows: DataFrame, role: Column, text: Column) -> DataFrame:
    """conv, turn, role, digest of the text, first fault of the row itself."""
    bare = F.rtrim(text, F.lit(BLANKS))
    return rows.select("conv", "turn", role.alias("role"), F.sha2(text, 256).alias("sha"), (bare == "").alias("blank"),
                       (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _segments(schema: pa.Schema):
    """Rows in the order (block, n, kind), where kind 0 marks that the row n is the first of its kind -> segments."""
    def one(conv, block, at, rows):
        codes, blank, repeated, cut, illegal, prev = bytearray(), 0, 0, 0, 0, None
        for _, role, is_blank, is_cut, first in rows:
            initial = role[:1]
            fault = GONE if is_blank or not first else CUT if is_cut else FINE
            blank += is_blank
            repeated += not is_blank and not first
            cut += fault == CUT
            if prev is not None and prev + initial not in ("su", "ua", "au"):
                illegal += 1
            prev = initial
            codes.append((INITIALS.index(initial) if initial and initial in INITIALS else 3) * 3 + fault)
        turns = [r[0] for r in rows if r[0] is not None]
        return (conv, block, at, bytes(codes), costs_through(codes), blank, repeated, cut, illegal, rows[0][1][:1], prev,
                turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)))

    def segments(batches):
        key, at, rows, first, out = None, None, [], None, []
        for b in batches:
            for block, n, kind, conv, turn, role, blank, cut in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    first = n
                    continue
                if rows and key != (block, conv):
                    out.append(one(key[1], key[0], at, rows))
                    rows = []
                if not rows:
                    key, at = (block, conv), n
                rows.append((turn, role, blank, cut, first == n))
            if out:
                yield _batch(out, schema)
                out = []
        if rows:
            yield _batch([one(key[1], key[0], at, rows)], schema)

    return segments


def _by_conversation(batches, width: int):
    """The rows (conv first) of one conversation at a time; those of equal ``conv`` follow each other."""
    held = []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns[:width])):
            if held and held[0][0] != r[0]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _checkpoints(schema: pa.Schema):
    """Segments of a conversation -> the state costs behind each, and on the first one the conversation's counts."""
    def one(rows):
        end, ends = END, []
        for r in reversed(rows):
            ends.append(list(end))
            table = r[2]
            end = tuple(min(table[4 * s + e] + end[e] for e in range(4)) for s in range(4))
        turns = [r for r in rows if r[9] is not None]
        distinct = sum(r[11] for r in turns) - sum(a[10] == b[9] for a, b in zip(turns, turns[1:]))
        gaps = turns[-1][10] - turns[0][9] + 1 - distinct if turns else 0
        illegal = sum(r[6] for r in rows) + sum(a[8] + b[7] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        counts = (gaps, sum(r[3] for r in rows), sum(r[4] for r in rows), sum(r[5] for r in rows), illegal, end[START])
        for i, (r, e) in enumerate(zip(rows, reversed(ends))):
            yield (r[0], r[1], e, i == 0, i == len(rows) - 1, *(counts if i == 0 else [None] * 6))

    def checkpoints(batches):
        out = []
        for rows in _by_conversation(batches, 12):
            out += one(rows)
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return checkpoints


def _walks(schema: pa.Schema):
    def walks(batches):
        for b in batches:
            out = []
            for at, conv, codes, end, first, last in zip(*(c.to_pylist() for c in b.columns)):
                found = [walk(codes, tuple(end), s, last) if s == START or not first else ("", s) for s in range(4)]
                out.append((conv, at, [f[0] for f in found], [f[1] for f in found]))
            yield _batch(out, schema)

    return walks


def _chain(schema: pa.Schema):
    def chain(batches):
        key, state, out = object(), START, []
        for b in batches:
            for conv, at, letters, ends in zip(*(c.to_pylist() for c in b.columns)):
                if conv != key:
                    key, state = conv, START
                out.append((conv, at, letters[state]))
                state = ends[state]
            yield _batch(out, schema)
            out = []

    return chain


def _edited(schema: pa.Schema):
    """Edits (kind 0, in order) and rows (kind 1, in order) of one conversation after another -> the edited rows."""
    def edited(batches):
        key, letters, at, state, pos, out = object(), [], 0, START, 0, []

        def inserts(stop):
            nonlocal at, state, pos
            while at < len(letters) and (stop is None or letters[at] == "I"):
                out.append((key, pos, "I", ROLES[NEED[state]], ""))
                state, at, pos = NEXT[state], at + 1, pos + 1

        for b in batches:
            for conv, kind, audit, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if conv != key:
                    inserts(None)
                    key, letters, at, state, pos = conv, "", 0, START, 0
                if kind == 0:
                    letters += audit
                    continue
                inserts("row")
                x = letters[at]
                if x == "R":
                    role, state = ROLES[NEED[state]], NEXT[state]
                elif x == "K":
                    state = KEPT[state, role[:1]]
                out.append((key, pos, x, role, text))
                at, pos = at + 1, pos + 1
            yield _batch(out, schema)
            out.clear()
        inserts(None)
        yield _batch(out, schema)

    return edited


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: the edited rows (conv_id, pos, edit, role, text) and the counts of each
    conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost).

    Rows are taken by turn, null turns first, rows of one turn by role and a digest of the text; equal rows are
    interchangeable. ``edit`` is K, R, D or I; deleted rows are listed with their own role and text. A conversation's
    rows are in one partition, one after another by ``pos``. A null role or text is one space; a null conv_id is a conversation of
    its own. Of an empty table both results are empty. Other columns are not read, whatever their names.
    Both results read written tables.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = rows.sparkSession
    keep = Scratch(spark)
    rows = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                       F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    conv_type = rows.schema["conv"].dataType
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    turn = F.col("turn").asc_nulls_first()

    def schema(ddl: str) -> T.StructType:
        return T.StructType([T.StructField(f.name, conv_type if f.name == "conv" else f.dataType) for f in T._parse_datatype_string(ddl)])

    def mapped(df: DataFrame, make, ddl: str) -> DataFrame:
        s = schema(ddl)
        return df.mapInArrow(make(to_arrow_schema(s)), s)

    # 1. ordered narrow rows; what is equal is dealt by its place in the input
    order = [F.col("conv").asc_nulls_first(), turn, F.col("role"), F.col("sha")]
    plain = narrow(rows, F.col("role"), F.col("text")).withColumn("_at", F.monotonically_increasing_id())
    ordered = plain.repartitionByRange(parts, *order, F.col("_at")).sortWithinPartitions(*order, F.col("_at")).drop("_at")
    ordered = keep.written(ordered.withColumn("n", F.monotonically_increasing_id()), "repair-rows")
    longest = ordered.groupBy("conv").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 1
    size = max(LEAST_BLOCK, math.isqrt(longest))
    block = F.floor(F.col("n") / size).cast("long").alias("block")
    firsts = ordered.groupBy("conv", "role", "sha").agg(F.min("n").alias("n"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("blank", "boolean"), ("cut", "boolean"))]
    both = (ordered.select(block, "n", F.lit(1).alias("kind"), "conv", "turn", "role", "blank", "cut")
            .unionByName(firsts.select(block, "n", F.lit(0).alias("kind"), "conv", *none)))
    segments = mapped(both.repartition(parts, "block").sortWithinPartitions("block", "n", "kind"), _segments,
                      "conv long, block long, at long, codes binary, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
                      "first_initial string, last_initial string, first_turn long, last_turn long, turns long")
    segments = keep.written(segments, "repair-segments")
    # 2. checkpoints, from the end of each conversation
    by_conv = [F.col("conv").asc_nulls_first(), F.col("at")]
    folded = segments.drop("block", "codes").select("conv", "at", "costs", "blank", "duplicate", "truncated", "illegal", "first_initial",
                                                    "last_initial", "first_turn", "last_turn", "turns")
    ends = mapped(folded.repartition(parts, "conv").sortWithinPartitions(*by_conv), _checkpoints,
                  "conv long, at long, end array<long>, first boolean, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
    ends = keep.written(ends, "repair-checkpoints")
    # 3. blocks recomputed; 4. chained
    walks = mapped(segments.select("at", "conv", "codes").join(ends.select("at", "end", "first", "last"), "at")
                   .select("at", "conv", "codes", "end", "first", "last"), _walks, "conv long, at long, letters array<string>, ends array<int>")
    edits = keep.written(mapped(walks.repartition(parts, "conv").sortWithinPartitions(*by_conv), _chain, "conv long, at long, audit string"), "repair-edits")
    # 5. the texts take their edits
    sha = F.sha2("text", 256)
    texts = rows.select("conv", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("at"), "turn", "role", sha.alias("sha"),
                        F.lit(None).cast("string").alias("audit"), "text")
    taken = texts.unionByName(edits.select("conv", F.lit(0).alias("kind"), "at", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                                           F.lit("").alias("sha"), "audit", F.lit("").alias("text")))
    taken = (taken.repartition(parts, "conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "kind", "at", turn, "role", "sha")
             .select("conv", "kind", "audit", "role", "text"))
    edited = mapped(taken, _edited, "conv long, pos long, edit string, role string, text string").withColumnRenamed("conv", "conv_id")
    counts = ends.where("first").select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return edited, counts


def digests(edited: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of the edited rows, which must come as ``repair`` gives them: the edits' letters,
    and the SHA-256 of the rows that stay, ``role:text`` joined by newlines. A stream: no conversation is held."""
    import hashlib

    from pyspark.sql.pandas.types import to_arrow_schema
    out_schema = T.StructType([edited.schema["conv_id"], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(out_schema)

    def digest(batches):
        key, letters, sha, started, out = None, [], hashlib.sha256(), False, []
        for b in batches:
            for conv, pos, edit, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if pos == 0:
                    if letters:
                        out.append((key, "".join(letters), sha.hexdigest()))
                    key, letters, sha, started = conv, [], hashlib.sha256(), False
                letters.append(edit)
                if edit != "D":
                    sha.update((("\n" if started else "") + f"{role}:{text}").encode())
                    started = True
            yield _batch(out, arrow)
            out = []
        if letters:
            yield _batch([(key, "".join(letters), sha.hexdigest())], arrow)

    return edited.select("conv_id", "pos", "edit", "role", "text").mapInArrow(digest, out_schema)
