"""Conversation structure repair (operator 13): dynamic programming with square-root checkpoints.

Rows are kept, given the role user or assistant, or deleted, and empty turns are inserted, so that the roles' initials
read ``(s?(ua)+)?``, at the least cost and, among equal costs, with the ASCII-least string of edits. Read so far, a
conversation is in one of four states (nothing, after s, after u, after a); the cost from a row and a state
to the end is a vector of four numbers. Such backward vectors are stored only at checkpoints, about the square root
of the rows apart; walking forward, the vectors of one block at a time are made again from the checkpoint behind
it, and the first edit in ASCII order that is tight is taken. An edit and a state fix the next state, so that is
the least string.

Conversations of ordinary size are dealt whole to chunks of bounded bytes by a hash of their id. A conversation of more than
``long_rows`` rows or ``long_bytes`` of text is split: its rows, sorted over all tasks, are cut into blocks of about the
square root of all such rows; each block gives its least costs from state to state (a 4 x 4 matrix, plus and
minimum), the matrices chained backwards give the vectors at the blocks' ends, each block then tells where each state
leaves it, and chained forwards that fixes the state in which each block is entered and so its edits. The last step, the hash
of the whole repaired text, reads a conversation's rows in order as a stream; SHA-256 allows no other way.

Order and faults, on rows after damage: by turn (nulls first), then role, then text; rows alike in all three are
interchangeable. Faults, the first counts: blank (no character but white space), duplicate (role and text
seen earlier in the conversation), truncated (the last such character is none of ``.!?``).

Defined cases: a null role or text is one space, a null conv_id is an id of its own; null turns come first and count
for no gap; rows that repeat are duplicates of each other; an empty table gives no rows, and a conversation without rows
after damage zeros, an empty audit and the hash of an empty string. Texts are held whole. Further input columns
are ignored.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import register

CHUNK_BYTES = 1 << 20
LONG_ROWS = 4096
LONG_BYTES = 4 << 20
INF = 1 << 60
SPACES = " \t\n\v\f\r"
END = (0, 10, 5, 0)  # cost from each state with no row left: inserts only
# a row's code: its role's initial, plus these
OTHER, S, U, A, TRUNCATED, MUST_GO = 0, 1, 2, 3, 4, 8
INITIAL = {"s": S, "u": U, "a": A}
OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
       "repaired_sha256 string")
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def kept_state(code: int, state: int) -> int:
    """State after a kept row, -1 if its role may not stand there."""
    role = code & 3
    if role == U:
        return -1 if state == 2 else 2
    if role == A:
        return 3 if state == 2 else -1
    return 1 if role == S and state == 0 else -1


KEPT = [[kept_state(code, s) for s in range(4)] for code in range(4)]
TURNED = (2, 2, 3, 2)  # state after a turn that is given the role it needs


def closed(c0: int, c1: int, c2: int, c3: int) -> tuple:
    """Costs when turns may be inserted first."""
    c2, c3 = min(c2, c3 + 5), min(c3, c2 + 5)
    return min(c0, c2 + 5), min(c1, c2 + 5), c2, c3


def before(code: int, v: tuple) -> tuple:
    """Costs before a row from the costs after it."""
    out = [x + 2 for x in v]
    if code < MUST_GO:
        more = 5 if code & TRUNCATED else 0
        kept = KEPT[code & 3]
        for s in range(4):
            cost = more + 1 + v[TURNED[s]]
            if cost < out[s]:
                out[s] = cost
            if kept[s] >= 0 and more + v[kept[s]] < out[s]:
                out[s] = more + v[kept[s]]
    return closed(*out)


def walk(codes: bytes, end: tuple, state: int, last: bool, edits: list | None = None, start: list | None = None) -> int:
    """Edits of rows with these codes, entered in ``state`` and followed by costs ``end``: into ``edits``, for each row
    the inserts before it and its own letter; if ``last``, inserts after the last row as a further entry.
    The costs at the first row go into ``start``. Returns the state behind the rows."""
    n = len(codes)
    step = max(1, isqrt(n))
    stops = list(range(0, n, step))
    at, v = {}, end
    for lo in reversed(stops):  # checkpoints
        hi = min(n, lo + step)
        at[hi] = v
        for i in range(hi - 1, lo - 1, -1):
            v = before(codes[i], v)
    if start is not None:
        start.append(v)
    for lo in stops:
        hi = min(n, lo + step)
        costs = [at[hi]]
        for i in range(hi - 1, lo - 1, -1):
            costs.append(before(codes[i], costs[-1]))
        costs.reverse()
        for i in range(lo, hi):
            here, after, code, own = costs[i - lo], costs[i - lo + 1], codes[i], ""
            more = 5 if code & TRUNCATED else 0
            while True:
                cost = here[state]
                if after[state] + 2 == cost:
                    own += "D"
                    break
                if here[TURNED[state]] + 5 == cost:
                    own += "I"
                    state = TURNED[state]
                    continue
                kept = KEPT[code & 3][state]
                if kept >= 0 and after[kept] + more == cost:
                    own += "K"
                    state = kept
                else:
                    own += "R"
                    state = TURNED[state]
                break
            if edits is not None:
                edits.append(own)
    if last:
        own = ""
        while end[state]:
            own += "I"
            state = TURNED[state]
        if edits is not None:
            edits.append(own)
    return state


class Digest:
    """Report of one conversation, fed with its rows in order."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.first = conv_id, 0, True
        self.n = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.turn = self.initial = None
        self.turns, self.audit, self.hash = 0, [], hashlib.sha256()

    def _line(self, line: str) -> None:
        self.hash.update((line if self.first else "\n" + line).encode("utf-8", "surrogatepass"))
        self.first = False

    def edit(self, letters: str, role: str = "", text: str = "", truncated: bool = False) -> None:
        for letter in letters:
            if letter == "D":
                self.n["cost"] += 2
                continue
            if letter == "K":
                self.state = KEPT[INITIAL.get(role[:1], OTHER)][self.state]
                name = role
            else:
                self.state = TURNED[self.state]
                name = "user" if self.state == 2 else "assistant"
                self.n["cost"] += 5 if letter == "I" else 1
            if letter != "I" and truncated:
                self.n["cost"] += 5
            self._line(f"{name}:{'' if letter == 'I' else text}")
        self.audit.append(letters)

    def row(self, turn, role: str, text: str, fault: str, letters: str) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn = self.high = turn
            self.turns += 1
        if fault:
            self.n[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.initial = role[:1]
        self.edit(letters, role, text, fault == "truncated")

    def result(self) -> tuple:
        if self.low is not None:
            self.n["gaps"] = self.high - self.low + 1 - self.turns
        return (self.conv_id, *(self.n[c] for c in COUNTS), "".join(self.audit), self.hash.hexdigest())


def report(rows: list[tuple]) -> pa.Table:
    names = [f.split()[0] for f in OUT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def fault_of(text: str) -> str:
    """Blank or truncated, else nothing."""
    text = text.rstrip(SPACES)
    return "blank" if not text else "" if text[-1] in ".!?" else "truncated"


def code_of(role: str, fault: str) -> int:
    return INITIAL.get(role[:1], OTHER) + (MUST_GO if fault in ("blank", "duplicate") else TRUNCATED if fault else 0)


def repair(conv_id, rows: list[tuple]) -> tuple:
    """Report of one whole conversation: (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        fault = fault_of(text)
        faults.append(fault if fault == "blank" or (role, text) not in seen else "duplicate")
        seen.add((role, text))
    edits: list[str] = []
    walk(bytes(code_of(r[1], f) for r, f in zip(rows, faults)), END, 0, True, edits)
    out = Digest(conv_id)
    for (turn, role, text), fault, letters in zip(rows, faults, edits):
        out.row(turn, role, text, fault, letters)
    out.edit(edits[-1])
    return out.result()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage; a dropped row stays as one with ``gone``, so its conversation is known."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(blank(conv), F.lit(":"), blank(turn)), "UTF-8")) % 20
    role, text = blank(F.col("role")), blank(F.col("text"))
    rows = conversations.select(conv.alias("conv_id"), turn.alias("turn"), kind.alias("kind"),
                                F.when(kind == 4, "user").otherwise(role).alias("role"),
                                F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
    return (rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("gone")))


def _of_chunk(part: pa.Table) -> pa.Table:
    order = pc.sort_indices(part, [(c, "ascending") for c in ("conv_id", "turn", "role", "text")], null_placement="at_start")
    out, own, last = [], [], None
    columns = [part[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")]
    for i in order.to_pylist():
        conv, turn, role, text, gone = (c[i] for c in columns)
        if last != (conv,):
            if last is not None:
                out.append(repair(last[0], own))
            last, own = (conv,), []
        if not gone:
            own.append((turn, role, text))
    if last is not None:
        out.append(repair(last[0], own))
    return report(out)


PIECE = "conv_id long, block long, {}"


def _pieces(part: pa.Table, work):
    """``work`` for every conversation in a block: its id and its rows' codes and places in order."""
    part = part.sort_by("pos")
    conv, code, pos = part["conv_id"].to_pylist(), bytes(part["code"].to_pylist()), part["pos"].to_pylist()
    lo = 0
    for hi in range(1, len(conv) + 1):
        if hi == len(conv) or conv[hi] != conv[lo]:
            yield work(conv[lo], code[lo:hi], pos[lo:hi])
            lo = hi


def _rows(found, names: list[str], kinds: list) -> pa.Table:
    found = list(found)
    return pa.table([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=names)


_LONGS = pa.list_(pa.int64())


def _matrices(part: pa.Table) -> pa.Table:
    def work(conv, codes, _):
        m = []
        for t in range(4):
            v = tuple(0 if s == t else INF for s in range(4))
            for code in reversed(codes):
                v = before(code, v)
            m += [min(x, INF) for x in v]
        return conv, block, m
    block = part["block"][0].as_py()
    return _rows(_pieces(part, work), ["conv_id", "block", "m"], [pa.int64(), pa.int64(), _LONGS])


def _ends(part: pa.Table) -> pa.Table:
    """Costs behind each block, from the matrices of the blocks after it."""
    rows, v, out = part.sort_by([("block", "descending")]).to_pylist(), END, []
    for r in rows:
        out.append((r["conv_id"], r["block"], list(v), v is END))
        v = closed(*(min(r["m"][4 * t + s] + v[t] for t in range(4)) for s in range(4)))
    return _rows(out, ["conv_id", "block", "costs", "last"], [pa.int64(), pa.int64(), _LONGS, pa.bool_()])


def _exits(part: pa.Table, ends: pa.Table) -> pa.Table:
    """The state in which each state leaves a block."""
    of = {r["conv_id"]: r for r in ends.to_pylist()}
    return _rows(_pieces(part, lambda conv, codes, _: (
        conv, of[conv]["block"], [walk(codes, tuple(of[conv]["costs"]), s, of[conv]["last"]) for s in range(4)],
        of[conv]["costs"], of[conv]["last"])),
        ["conv_id", "block", "exits", "costs", "last"], [pa.int64(), pa.int64(), _LONGS, _LONGS, pa.bool_()])


def _entries(part: pa.Table) -> pa.Table:
    state, out = 0, []
    for r in part.sort_by("block").to_pylist():
        out.append((r["conv_id"], r["block"], r["costs"], r["last"], state))
        state = r["exits"][state]
    return _rows(out, ["conv_id", "block", "costs", "last", "state"], [pa.int64(), pa.int64(), _LONGS, pa.bool_(), pa.int64()])


def _letters(part: pa.Table, ends: pa.Table) -> pa.Table:
    """Edits of every row; those after a conversation's last row stand behind its own, after a blank."""
    of = {r["conv_id"]: r for r in ends.to_pylist()}
    out = []

    def work(conv, codes, pos):
        own = of[conv]
        edits: list[str] = []
        walk(codes, tuple(own["costs"]), own["state"], own["last"], edits)
        if own["last"] and edits[-1]:
            edits[len(pos) - 1] += " " + edits[-1]
        out.extend(zip(pos, edits))

    for _ in _pieces(part, work):
        pass
    return _rows(out, ["pos", "letters"], [pa.int64(), pa.string()])


def _streamed(batches):
    """Reports of conversations whose rows come in order, over any number of batches."""
    own = None
    for batch in batches:
        done = []
        for conv, turn, role, text, fault, letters in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "letters"))):
            if own is None or own.conv_id != conv:
                if own:
                    done.append(own.result())
                own = Digest(conv)
            here, _, behind = letters.partition(" ")
            own.row(turn, role, text, fault, here)
            own.edit(behind)
        if done:
            yield from report(done).to_batches()
    if own:
        yield from report([own.result()]).to_batches()


def _split(rows: DataFrame) -> DataFrame:
    """Reports of conversations that are too large for one task's memory."""
    key = ["conv_id", "turn", "role", "text"]
    spread = rows.withColumn("spread", F.monotonically_increasing_id())  # equal rows may lie in several ranges
    ordered = stored(spread.repartitionByRange(*key, "spread").sortWithinPartitions(*key, "spread")
                     .withColumn("pos", F.monotonically_increasing_id())
                     .withColumn("said", F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256)), "ordered")
    n = ordered.count()
    width = max(4, (isqrt(n) - 1).bit_length())  # blocks of about the square root of the rows
    body = F.rtrim(F.translate("text", SPACES[1:], " " * (len(SPACES) - 1)))
    first = ordered.groupBy("conv_id", "role", "said").agg(F.min("pos").alias("first"))
    same = F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("o.role") == F.col("f.role")) & (F.col("o.said") == F.col("f.said"))
    fault = (F.when(body == "", "blank").when(F.col("pos") != F.col("first"), "duplicate")
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated").otherwise(""))
    initial = F.substring("o.role", 1, 1)
    role = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    more = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", TRUNCATED).otherwise(0)
    coded = stored(ordered.alias("o").join(first.alias("f"), same)
                   .select("o.conv_id", "pos", F.shiftright("pos", width).alias("block"), fault.alias("fault"), role.alias("initial"))
                   .select("conv_id", "pos", "block", "fault", (F.col("initial") + more).cast("int").alias("code")), "coded")
    blocks = coded.select("conv_id", "pos", "block", "code").groupBy("block")
    ends = (blocks.applyInArrow(_matrices, PIECE.format("m array<long>")).groupBy("conv_id")
            .applyInArrow(_ends, PIECE.format("costs array<long>, last boolean")))
    exits = blocks.cogroup(stored(ends, "ends").groupBy("block")).applyInArrow(
        _exits, PIECE.format("exits array<long>, costs array<long>, last boolean"))
    entries = exits.groupBy("conv_id").applyInArrow(_entries, PIECE.format("costs array<long>, last boolean, state long"))
    letters = blocks.cogroup(stored(entries, "entries").groupBy("block")).applyInArrow(_letters, "pos long, letters string")
    told = ordered.select(*key, "pos").join(coded.select("pos", "fault"), "pos").join(letters, "pos")
    return (told.repartition("conv_id").sortWithinPartitions(F.col("conv_id").isNotNull(), "conv_id", "pos")
            .select("conv_id", "turn", "role", "text", "fault", "letters").mapInArrow(_streamed, OUT))


def repair_conversations(conversations: DataFrame, chunk_bytes: int = CHUNK_BYTES, long_rows: int = LONG_ROWS,
                         long_bytes: int = LONG_BYTES) -> DataFrame:
    """Report of each conversation of rows (conv_id, turn, role, text, gone): faults, cost, edits and repaired text's hash."""
    size = stored(conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")), "sizes")
    is_long = (F.col("n") > long_rows) | (F.col("bytes") > long_bytes)
    total, n_long = size.agg(F.sum("bytes"), F.count_if(is_long)).first()
    chunks = 1 + (total or 0) // chunk_bytes
    whole, split = conversations, None
    if n_long:
        large = stored(size.where(is_long).select(F.col("conv_id").alias("_id")), "long")
        same = F.col("conv_id").eqNullSafe(F.col("_id"))
        whole = conversations.join(large, same, "left_anti")
        done = _split(conversations.where(~F.col("gone")).join(large, same, "left_semi").drop("gone")).withColumnRenamed("conv_id", "_done")
        none: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in COUNTS}
        split = (large.join(done, F.col("_id").eqNullSafe(F.col("_done")), "left")
                 .select(F.col("_id").alias("conv_id"), *[v.alias(c) for c, v in none.items()],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
    dealt = whole.withColumn("chunk", F.pmod(F.xxhash64("conv_id"), F.lit(chunks)))
    out = dealt.groupBy("chunk").applyInArrow(_of_chunk, OUT)
    return out if split is None else out.unionByName(split)


@register("op13_checkpoint_repair")
def op13_checkpoint_repair(spark, sf_dir):
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))
