r"""Conversation structure repair by generalised LR parsing (operator 12).

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``.  Each
row may be kept (0), reroled to user or assistant (2) or deleted (3); empty-text user and
assistant turns may be inserted anywhere (2).  Blank rows and rows that repeat an earlier
(role, text) must be deleted; a truncated row that stays costs 1 more.  Wanted is the
cheapest repair, and of equally cheap ones the one whose audit (the initials of its edits
in order) is ASCII-least.

*Parsing.*  Rows are read from the last to the first with the mirrored grammar
``C -> e | P | P s,  P -> a u | P a u`` and its LR table.  Every edit is an action on the
stack tops of a graph-structured stack: keep and rerole shift a token (and reduce), delete leaves the stack,
insert shifts a token without reading a row.  Tops with equal stacks merge by minimum
(cost, audit).  Read backwards an audit grows at its front, so two audits compare by
their first edit and then by the rank of what they were put before: one number for each
top instead of a string.  A conversation of n rows takes n steps and 5 bytes a row.

*On Spark.*  Rows go through as one byte each (role class and fault).  Range partitioning
by (conversation, order) cuts a conversation of any length into pieces over many tasks;
only the bytes of its pieces meet (as long as the audit to be returned).  Earlier equal rows
are found by map-side minima of (order) by (conversation, digest), and only digests that occur twice
are joined back.  Decisions return to rows by a join on a row number, so texts are never
gathered by conversation.

Order: by turn, nulls first; rows of one turn by role, then by the first 64 characters of the
text, then by digest.  Defined results: a null role or text is one blank; a null conversation is a
conversation of its own; empty texts are blank; texts of any length are read whole; repeated rows are duplicates; roles whose
initial is not s, u or a can only be reroled or deleted; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.llm.common import ASCII_SPACE, limit_batches, ship, shuffle_width, written

ship(__name__)

# fixed values: what the edits cost
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"s": "system", "u": "user", "a": "assistant"}
CLASSES = "sua?"                        # role classes by number; ? is any other role
NONE, BLANK, DUPLICATE, CUT = range(4)  # faults by number
CACHED_ROWS = 64

# the LR table of the mirrored grammar: shifts, reductions (symbol, length), gotos
SHIFT = {(0, "a"): 1, (1, "u"): 5, (2, "a"): 3, (2, "s"): 4, (3, "u"): 6}
REDUCE = {5: ("P", 2), 6: ("P", 3)}
GOTO = {(0, "P"): 2}
ACCEPT = (0, 2, 4)
STACKS = [(0,), (0, 1), (0, 2), (0, 2, 3), (0, 2, 4)]


def advance(stack: tuple[int, ...], token: str) -> tuple[int, ...] | None:
    """The stack after a token and the reductions that follow; none if it can't be shifted."""
    to = SHIFT.get((stack[-1], token))
    if to is None:
        return None
    stack = (*stack, to)
    while stack[-1] in REDUCE:
        symbol, length = REDUCE[stack[-1]]
        stack = stack[:-length]
        stack = (*stack, GOTO[stack[-1], symbol])
    return stack


#: moves[top] = {token: next top}, tops numbered as in STACKS
MOVES = [{t: STACKS.index(to) for t in "sua" if (to := advance(s, t))} for s in STACKS]
EDITS = "DIKR"


def _inserts(tops: dict[int, tuple], back: bytearray, at: int) -> None:
    """Closes a frontier under insertions, the cheapest tops first."""
    done: set[int] = set()
    while rest := [t for t in tops if t not in done]:
        top = min(rest, key=lambda t: tops[t])
        done.add(top)
        cost, key = tops[top]
        for token, to in MOVES[top].items():
            new = (cost + INSERT, ("I", key))
            if token != "s" and to not in done and (to not in tops or new < tops[to]):
                tops[to] = new
                back[at + to] = 1 + 16 * EDITS.index("I") + 2 * top


def parse(symbols: bytes) -> tuple[int, str, str]:
    """(cost, audit, tokens) of the best repair of rows given as 4 * class + fault;
    ``tokens`` has the role class of each edit's turn (``-``: deleted)."""
    n, width = len(symbols), len(STACKS)
    back = bytearray(width * (n + 1))             # edit, top before, whether of the same frontier
    tops: dict[int, tuple] = {0: (0, ("",))}
    _inserts(tops, back, width * n)
    for i in range(n - 1, -1, -1):
        role, fault = CLASSES[symbols[i] // 4], symbols[i] % 4
        order = {t: k for k, t in enumerate(sorted(tops, key=lambda t: tops[t][1]))}
        new: dict[int, tuple] = {}
        for top, (cost, _) in tops.items():
            edits = [("D", top, DELETE)]
            if fault in (NONE, CUT):
                more = TRUNCATED * (fault == CUT)
                edits += [("K" if t == role else "R", to, more + REROLE * (t != role))
                          for t, to in MOVES[top].items() if t == role or t != "s"]
            for edit, to, price in edits:
                got = (cost + price, (edit, order[top]))
                if to not in new or got < new[to]:
                    new[to] = got
                    back[width * i + to] = 16 * EDITS.index(edit) + 2 * top
        tops = new
        _inserts(tops, back, width * i)
    top = min((t for t in tops if STACKS[t][-1] in ACCEPT), key=lambda t: tops[t])
    cost, i, audit, tokens = tops[top][0], 0, [], []
    token_of = [{to: t for t, to in m.items()} for m in MOVES]
    while i < n or top:
        x = back[width * i + top]
        edit, before = EDITS[x >> 4], x >> 1 & 7
        audit.append(edit)
        tokens.append("-" if edit == "D" else token_of[before][top])
        i, top = i + (edit != "I"), before
    return cost, "".join(audit), "".join(tokens)


@lru_cache(1 << 14)
def _parse_short(symbols: bytes) -> tuple[int, str, str]:
    return parse(symbols)


def repair(symbols: bytes) -> tuple[int, str, str]:
    """``parse``; the answers of short conversations are remembered."""
    return _parse_short(symbols) if len(symbols) <= CACHED_ROWS else parse(symbols)


def illegal_pairs(symbols: bytes) -> int:
    """Adjacent rows whose role initials are none of su, ua, au."""
    c = np.frombuffer(symbols, np.uint8) // 4
    legal = ((c[:-1] == 0) & (c[1:] == 1)) | ((c[:-1] == 1) & (c[1:] == 2)) | ((c[:-1] == 2) & (c[1:] == 1))
    return int((~legal).sum())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, turn, symbol, uid) -> one row for each conversation of each batch."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    for seq, b in enumerate(batches):
        if not b.num_rows:
            continue
        runs = pc.run_end_encode(b.column(0))
        ends = runs.run_ends.to_numpy().astype(np.int64)
        starts = np.r_[0, ends[:-1]]
        symbol = b.column(2).to_numpy().astype(np.uint8)
        uid = b.column(3).to_numpy().astype("<i8")
        seen = b.column(1).is_valid().to_numpy(zero_copy_only=False)
        turn = pc.fill_null(b.column(1), 0).to_numpy()
        low, high, distinct = [], [], []
        for s, e in zip(starts.tolist(), ends.tolist()):
            own = turn[s:e][seen[s:e]]
            low.append(int(own[0]) if len(own) else None)
            high.append(int(own[-1]) if len(own) else None)
            distinct.append(int(len(own) > 0) + int((own[1:] != own[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [runs.values, pa.array(np.full(len(ends), part, np.int32)), pa.array(np.full(len(ends), seq, np.int32)),
             pa.array([symbol[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
             pa.array([uid[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
             pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(distinct, pa.int64())],
            names=["conv_id", "part", "seq", "symbols", "uids", "low", "high", "turns"])


def _gaps(pieces: list[dict]) -> int:
    own = [p for p in pieces if p["turns"]]
    if not own:
        return 0
    distinct = sum(p["turns"] for p in own) - sum(a["high"] == b["low"] for a, b in zip(own, own[1:]))
    return own[-1]["high"] - own[0]["low"] + 1 - distinct


def _slices(pieces: list[dict], audit: str, tokens: str) -> list[dict]:
    """What of the audit belongs to each piece; insertions go with the row after them."""
    out, at, pos = [], 0, 0
    for k, p in enumerate(pieces):
        start, left = at, len(p["symbols"])
        while left or (k == len(pieces) - 1 and at < len(audit)):
            left -= audit[at] != "I"
            at += 1
        out.append({"part": p["part"], "seq": p["seq"], "pos": pos, "audit": audit[start:at],
                    "tokens": tokens[start:at]})
        pos += sum(c != "D" for c in audit[start:at])
    return out


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, pieces in order) -> counts, cost and audit, and each piece's part of it."""
    piece = pa.struct([("part", pa.int32()), ("seq", pa.int32()), ("pos", pa.int64()),
                       ("audit", pa.string()), ("tokens", pa.string())])
    for b in batches:
        counts, audits, slices = [], [], []
        for own in b.column(1):
            pieces = own.as_py()
            symbols = b"".join([p["symbols"] for p in pieces])
            fault = np.bincount(np.frombuffer(symbols, np.uint8) % 4, minlength=4)
            cost, audit, tokens = repair(symbols)
            counts.append((_gaps(pieces), *fault[1:].tolist(), illegal_pairs(symbols), cost))
            audits.append(audit)
            slices.append(_slices(pieces, audit, tokens))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(6)],
             pa.array(audits, pa.string()), pa.array(slices, pa.list_(piece))],
            names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "slices"])


def _decisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, pos, audit, tokens, uids) -> one row per turn of the repaired conversation."""
    for b in batches:
        row, pos, uid, edit, role = [], [], [], [], []
        for i, (at, audit, tokens, uids) in enumerate(zip(*[b.column(k).to_pylist() for k in range(1, 5)])):
            rows = iter(np.frombuffer(uids, "<i8").tolist())
            for e, t in zip(audit, tokens):
                own = None if e == "I" else next(rows)
                if e == "D":
                    continue
                row.append(i)
                pos.append(at)
                uid.append(own)
                edit.append(e)
                role.append(None if e == "K" else ROLES[t])
                at += 1
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(row, pa.int64())), pa.array(pos, pa.int64()), pa.array(uid, pa.int64()),
             pa.array(edit, pa.string()), pa.array(role, pa.string())],
            names=["conv_id", "pos", "uid", "edit", "new_role"])


def _text_fault(text: Column) -> Column:
    """Faults that a text has on its own: blank, or no final mark."""
    last = F.substring(F.rtrim(text, F.lit(ASCII_SPACE)), -1, 1)
    return F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(NONE)


def _role_class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(plan, turns)``.  ``plan``: one row per conversation with rows: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit.  ``turns``: the repaired conversations,
    one row per turn: conv_id, pos (from 0), edit (K, R or I), role, text."""
    spark = rows.sparkSession
    limit_batches(spark)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        blank(role_col).alias("role"), blank(text_col).alias("text"))
    base = written(named.select(
        "*", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        _text_fault(F.col("text")).alias("fault"), F.monotonically_increasing_id().alias("uid")), "op12-rows")

    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "uid")
    first = written(base.where(F.col("fault") != BLANK).groupBy("conv_id", "digest")
                    .agg(F.count("*").alias("n"), F.min(when).alias("first"))
                    .where("n > 1").select("conv_id", "digest", F.col("first.uid").alias("first")), "op12-first")
    slim = base.select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("begin"), "digest", "fault", "uid")
    told = slim.alias("r").join(first.alias("f"), F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))
                                & (F.col("r.digest") == F.col("f.digest")), "left")
    fault = F.when((F.col("r.fault") != BLANK) & (F.col("f.first") != F.col("r.uid")), DUPLICATE) \
        .otherwise(F.col("r.fault"))
    order = ["conv_id", "turn", "role", "begin", "digest", "uid"]
    marked = told.select(*[F.col(f"r.{c}").alias(c) for c in order],
                         (_role_class(F.col("r.role")) * 4 + fault).alias("symbol"))
    kind = dict(base.dtypes)["conv_id"]
    dealt = marked.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    pieces = written(dealt.select("conv_id", "turn", "symbol", "uid").mapInArrow(
        _pieces, f"conv_id {kind}, part int, seq int, symbols binary, uids binary, low long, high long, turns long"),
        "op12-pieces")

    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("part", "seq", "symbols", "low", "high", "turns"))).alias("pieces"))
    plan = written(whole.mapInArrow(_plan, (
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, slices array<struct<part int, seq int, pos long, audit string, tokens string>>")), "op12-plan")

    own = plan.select(F.col("conv_id").alias("c"), F.explode("slices").alias("s"))
    joined = own.join(pieces, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("s.part") == F.col("part"))
                      & (F.col("s.seq") == F.col("seq")))
    decided = joined.select("conv_id", "s.pos", "s.audit", "s.tokens", "uids").mapInArrow(
        _decisions, f"conv_id {kind}, pos long, uid long, edit string, new_role string")
    texts = base.select(F.col("uid").alias("own"), "role", "text")
    turns = decided.join(texts, F.col("uid") == F.col("own"), "left").select(
        "conv_id", "pos", "edit", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    return plan.drop("slices"), turns


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by (conv_id, pos) -> SHA-256 of each conversation, one text in memory at a time."""
    import hashlib
    at, state, ids, out = None, None, [], []
    for b in batches:
        for conv, pos, role, text in zip(*[b.column(k).to_pylist() for k in range(4)]):
            if state is None or pos == 0:
                if state is not None:
                    ids.append(at)
                    out.append(state.hexdigest())
                at, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(out, pa.string())],
                                         names=["conv_id", "repaired_sha256"])
        ids, out = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], b.schema.field(0).type),
                                          pa.array([state.hexdigest()], pa.string())],
                                         names=["conv_id", "repaired_sha256"])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the ``role:text`` lines.  A SHA-256 is sequential, so the
    texts of one conversation pass one task, in order, and are not held there."""
    dealt = turns.repartition(shuffle_width(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "pos")
    return dealt.select("conv_id", "pos", "role", "text").mapInArrow(
        _digests, f"conv_id {dict(turns.dtypes)['conv_id']}, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Faults by rule, for tests of the repair: by crc32(``conv_id:turn``) % 20 a row is
    dropped (0), emptied (1), loses its ``.!?`` (2), is repeated (3) or gets the role user (4)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                       code.alias("code")).where("code <> 0") \
        .select("conv_id", "turn",
                F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
                .otherwise(F.col("text")).alias("text"), F.explode(copies)) \
        .select("conv_id", "turn", "role", "text")


def repair_report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation of ``ids (conv_id)``: the plan of ``rows`` and the digest of the
    repaired conversation; zeros, an empty audit and the digest of no text where no row is left."""
    plan, turns = repair_conversations(rows)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    named = ids.select(F.col("conv_id").alias("id")).distinct()
    d = conversation_digests(turns).alias("d")
    out = named.join(plan.alias("p"), F.col("id").eqNullSafe(F.col("p.conv_id")), "left") \
        .join(d, F.col("id").eqNullSafe(F.col("d.conv_id")), "left")
    counts = [F.coalesce(F.col(f"p.{c}"), F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *counts, F.coalesce("p.audit", F.lit("")).alias("audit"),
                      F.coalesce("d.repaired_sha256", empty).alias("repaired_sha256"))
