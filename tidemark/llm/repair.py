"""Conversation structure repair by Four-Russians block tables (operator 11).

A conversation's rows become symbols: rows that must go (blank or duplicate), and the others by the initial of their
role and by whether they are truncated. The cheapest edits that give role initials ``(s?(ua)+)?`` are a shortest path
through four states (nothing yet, after s, after u, after a). The costs to go from the four states, less the least of
them, take few different values, so with fixed-length blocks of symbols:

1. Tables give, for every vector of costs after a block and every block, the vector before it, the cost added, and the
   state in which the cheapest edits leave the block for each state in which they enter it. Ties go to the
   ASCII-least edit, which is known from the front once the costs to go are known from the back.
2. Rows are put in order, dealt by ranges, and cut into chunks of at most 4,096 rows. A chunk is processed by block
   lookups for every vector that may follow it, and so becomes a small table of its own.
3. One pass over each conversation's chunks from the back gives the vector after each, one from the front the state
   before each: streams that hold one vector and one state, so a conversation may have any number of rows.
4. Every chunk's blocks are expanded backward from the vector after it, then its edits are read forward.
5. Edits meet their rows in a stream sorted by conversation, which puts out the repaired turns in order.

Nulls and edge cases: a null id, role or text counts as one space (rows with a null id are one conversation, returned
with a null id); null turns come first and are ignored in gaps. Rows of equal turn are ordered by role and text;
repeated rows are duplicates. Roles are told by their first character, case matters; an empty role has none and is
never kept. Very long texts are carried whole, a batch of rows at a time. Other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.ordered import chunk_of, in_order

DELETE, INSERT, RELABEL, TRUNCATED = 3, 2, 2, 1
BLOCK = 3
BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"

# states: 0 nothing yet, 1 after s, 2 after u, 3 after a; the state after each initial, and what a new role must be
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
END = (0, 4, 2, 0)
INITIALS = "suax"
# symbols: 0 no row (fills blocks), 1 a row that must go, then 2 + 2 * initial + truncated
SYMBOLS = 2 + 2 * len(INITIALS)


def _initial(symbol: int) -> str:
    return INITIALS[(symbol - 2) // 2]


def _choices(symbol: int, state: int, after: tuple[int, ...]) -> Iterator[tuple[str, int, int]]:
    """(edit, cost from here on, next state) of the edits that use up the row, ``after`` being the costs to go behind it."""
    yield "D", DELETE + after[state], state
    if symbol > 1:
        extra = TRUNCATED * (symbol % 2)
        kept = AFTER[state].get(_initial(symbol))
        if kept is not None:
            yield "K", extra + after[kept], kept
        yield "R", RELABEL + extra + after[AFTER[state][WANTED[state]]], AFTER[state][WANTED[state]]


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The costs to go before a row, inserts included."""
    if symbol == 0:
        return after
    costs = [min(c for _, c, _ in _choices(symbol, q, after)) for q in range(4)]
    for _ in range(2):  # two inserts lead to any state
        costs = [min(c, INSERT + costs[AFTER[q][WANTED[q]]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _edits(symbol: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with the row, and the state behind it."""
    costs, out = _before(symbol, after), ""
    while symbol:
        found = {letter: to for letter, cost, to in _choices(symbol, state, after) if cost == costs[state]}
        if "D" in found:
            return out + "D", state
        to = AFTER[state][WANTED[state]]
        if INSERT + costs[to] == costs[state]:
            out, state = out + "I", to
            continue
        letter = min(found)
        return out + letter, found[letter]
    return out, state


class Tables:
    """Vectors of costs to go (normalised, the end's first), and their transitions by symbol and by block."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END]
        known, steps = {END: 0}, []
        for vector in self.vectors:  # grows until closed under all symbols
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(symbol, vector)
                norm = tuple(c - min(costs) for c in costs)
                if norm not in known:
                    known[norm] = len(self.vectors)
                    self.vectors.append(norm)
                row.append((known[norm], min(costs)))
            steps.append(row)
        self.step = np.array([[s[0] for s in row] for row in steps], np.int16)
        self.cost = np.array([[s[1] for s in row] for row in steps], np.int64)
        leave = np.array([[[_edits(x, q, v)[1] for q in range(4)] for x in range(SYMBOLS)] for v in self.vectors], np.int8)
        # blocks are numbers in base SYMBOLS, the first symbol the highest digit; each turn puts a symbol in front
        n = len(self.vectors)
        self.before = np.arange(n, dtype=np.int16)[:, None]
        self.added = np.zeros((n, 1), np.int64)
        self.leave = np.broadcast_to(np.arange(4, dtype=np.int8), (n, 1, 4))
        for _ in range(block):
            first = np.repeat(np.arange(SYMBOLS), self.before.shape[1])
            behind = np.tile(self.before, SYMBOLS)
            into = leave[behind, first]
            self.leave = np.take_along_axis(np.tile(self.leave, (1, SYMBOLS, 1)), into.astype(np.int64), axis=2)
            self.added = np.tile(self.added, SYMBOLS) + self.cost[behind, first]
            self.before = self.step[behind, first]
        self.expand = lru_cache(1 << 17)(self._expand)

    def blocks(self, symbols: np.ndarray) -> np.ndarray:
        """The blocks of a run of symbols, filled up in front."""
        fill = -len(symbols) % self.block
        digits = np.r_[np.zeros(fill, np.int64), symbols].reshape(-1, self.block)
        return digits @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))

    def summary(self, chunks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each chunk and each vector after it: the vector before it, the cost added, the states left by state entered."""
        n = len(self.vectors)
        blocks = [self.blocks(c) for c in chunks]
        before = np.tile(np.arange(n, dtype=np.int16), (len(chunks), 1))
        added = np.zeros((len(chunks), n), np.int64)
        leave = np.tile(np.arange(4, dtype=np.int8), (len(chunks), n, 1))
        sizes = np.array([len(b) for b in blocks])
        for k in range(1, int(sizes.max(initial=0)) + 1):
            on = np.flatnonzero(sizes >= k)
            block = np.array([blocks[i][-k] for i in on])[:, None]
            into = self.leave[before[on], block].astype(np.int64)
            leave[on] = np.take_along_axis(leave[on], into, axis=2)
            added[on] += self.added[before[on], block]
            before[on] = self.before[before[on], block]
        return before, added, leave

    def _expand(self, block: int, state: int, after: int) -> tuple[str, int]:
        """The edits of a block entered in a state, and the state in which they leave it."""
        digits = [block // SYMBOLS ** k % SYMBOLS for k in range(self.block - 1, -1, -1)]
        behind = [after]
        for symbol in digits[:0:-1]:
            behind.append(int(self.step[behind[-1], symbol]))
        out = ""
        for symbol, vector in zip(digits, reversed(behind)):
            letters, state = _edits(symbol, state, self.vectors[vector])
            out += letters
        return out, state

    def trace(self, symbols: np.ndarray, state: int, after: int) -> tuple[str, int]:
        """The edits of a chunk entered in a state, and the state in which they leave it."""
        blocks = self.blocks(symbols).tolist()
        behind = [after]
        for block in blocks[:0:-1]:
            behind.append(int(self.before[behind[-1], block]))
        out = []
        for block, vector in zip(blocks, reversed(behind)):
            letters, state = self.expand(block, state, vector)
            out.append(letters)
        return "".join(out), state


@lru_cache(4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def last_inserts(state: int) -> int:
    """How many inserts end a conversation from a state."""
    return END[state] // INSERT


# --- Spark ------------------------------------------------------------------------------------------------


def _ordered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows in order: conv, pos, chunk, turn, role, text, blank, truncated, initial, two hashes of role and text."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)

    said = rows.select(shown("conv_id").alias("conv"), F.col("turn").alias("turn"), shown("role"), shown("text"))
    first = F.left("role", F.lit(1))
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    marked = said.select(
        "*", (end == "").alias("blank"), ((end != "") & ~end.isin(".", "!", "?")).alias("truncated"),
        F.when(first.isin(*INITIALS[:3]), first).otherwise(INITIALS[3]).alias("initial"),
        F.xxhash64(F.lit(1), "role", "text").alias("one"), F.xxhash64(F.lit(2), "text", "role").alias("two"))
    # the range sampling sees keys of a bounded size: ranges are cut by the start of a text, tasks sort by all of it
    ranges = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(64))]
    return in_order(marked, ranges, [F.col("text")], scratch, "rows").withColumn("chunk", chunk_of(F.col("pos")))


def _with_duplicates(rows: DataFrame) -> DataFrame:
    """conv, chunk, pos, initial, blank, duplicate, truncated: each row's first fault only."""
    key = ["conv", "one", "two"]
    narrow = rows.select(*key, "chunk", "pos", "initial", "blank", "truncated")
    again = narrow.where(~F.col("blank")).groupBy(*key).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    duplicate = F.coalesce(~F.col("blank") & (F.col("pos") > F.col("first")), F.lit(False))
    return narrow.join(again.drop("n"), key, "left").select(
        "conv", "chunk", "pos", "initial", "blank", duplicate.alias("duplicate"),
        (F.col("truncated") & ~duplicate).alias("truncated"))


def _symbols(faults: DataFrame) -> DataFrame:
    """(conv, chunk, symbols, initials): a string of digits and one of initials for the rows of a chunk, in order."""
    place = F.instr(F.lit(INITIALS), F.col("initial")) - 1
    symbol = F.when(F.col("blank") | F.col("duplicate"), 1).otherwise(2 + 2 * place + F.col("truncated").cast("int"))
    # at most 4,096 rows a group
    listed = faults.select("conv", "chunk", F.struct("pos", symbol.alias("symbol"), "initial").alias("row")).groupBy(
        "conv", "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return listed.select("conv", "chunk", F.array_join(F.transform("rows", lambda r: r["symbol"].cast("string")), "").alias("symbols"),
                         F.array_join("rows.initial", "").alias("initials"))


def _digits(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8).astype(np.int64) - ord("0")


def _summaries(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, before, added, leave, illegal, first, last): each chunk as a table over the vectors after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                before, added, leave = tables().summary([_digits(x) for x in part.column(2).to_pylist()])
                initials = part.column(3).to_pylist()
                illegal = [sum(i[k:k + 2] not in ("su", "ua", "au") for k in range(len(i) - 1)) for i in initials]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array([x.tobytes() for x in c], pa.binary()) for c in (before, added, leave)],
                     pa.array(illegal, pa.int64()), pa.array([i[0] for i in initials]), pa.array([i[-1] for i in initials])],
                    names=["conv", "chunk", "before", "added", "leave", "illegal", "first", "last"])

    return chunks.select("conv", "chunk", "symbols", "initials").mapInArrow(
        run, "conv string, chunk long, before binary, added binary, leave binary, illegal long, first string, last string")


def _from_the_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks, last first, get ``after`` (the vector behind) and ``leave`` for it; a conversation's first gets its cost."""
    conv, vector, total = None, 0, 0
    for batch in batches:
        out = {"after": [], "leave": [], "is_last": [], "cost": []}
        for name, before, added, leave in zip(*(batch.column(c).to_pylist() for c in ("conv", "before", "added", "leave"))):
            if name != conv:
                conv, vector, total = name, 0, 0
                out["is_last"].append(True)
            else:
                out["is_last"].append(False)
            out["after"].append(vector)
            out["leave"].append(leave[4 * vector:4 * vector + 4])
            total += int(np.frombuffer(added, np.int64)[vector])
            vector = int(np.frombuffer(before, np.int16)[vector])
            out["cost"].append(total + tables().vectors[vector][0])  # right for a conversation's first chunk
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv", "chunk", "illegal", "first", "last")] +
            [pa.array(out["after"], pa.int32()), pa.array(out["leave"], pa.binary()), pa.array(out["is_last"], pa.bool_()),
             pa.array(out["cost"], pa.int64())],
            names=["conv", "chunk", "illegal", "first", "last", "after", "leave", "is_last", "cost"])


def _from_the_front(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks, first first, get ``state`` (in which they are entered); costs and border pairs are settled."""
    conv, state, last = None, 0, ""
    for batch in batches:
        states, illegal, costs = [], [], []
        for name, leave, cost, inside, first, end in zip(*(batch.column(c).to_pylist() for c in ("conv", "leave", "cost", "illegal", "first", "last"))):
            if name != conv:
                conv, state, last = name, 0, ""
            costs.append(0 if last else cost)
            illegal.append(inside + (last != "" and last + first not in ("su", "ua", "au")))
            states.append(state)
            state, last = leave[state], end
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv", "chunk", "after", "is_last")] +
            [pa.array(states, pa.int32()), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64())],
            names=["conv", "chunk", "after", "is_last", "state", "illegal", "cost"])


def _scanned(summaries: DataFrame) -> DataFrame:
    """(conv, chunk, after, is_last, state, illegal, cost): small rows, one for each chunk, streamed by conversation."""
    back = summaries.repartition("conv").sortWithinPartitions("conv", F.desc("chunk")).mapInArrow(
        _from_the_back, "conv string, chunk long, illegal long, first string, last string, after int, leave binary, is_last boolean, cost long")
    return back.sortWithinPartitions("conv", "chunk").mapInArrow(
        _from_the_front, "conv string, chunk long, after int, is_last boolean, state int, illegal long, cost long")


def _traced(chunks: DataFrame, scanned: DataFrame) -> DataFrame:
    """(conv, chunk, state, edits): the edits of each chunk, those after the last row with the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = []
            for symbols, after, state, is_last in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5))):
                letters, state = tables().trace(_digits(symbols), state, after)
                edits.append(letters + "I" * (last_inserts(state) if is_last else 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(edits, pa.string())],
                                             names=["conv", "chunk", "state", "edits"])

    return chunks.join(scanned, ["conv", "chunk"]).select("conv", "chunk", "symbols", "after", "state", "is_last").mapInArrow(
        run, "conv string, chunk long, state int, edits string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of a stream sorted by conv, chunk, kind, pos: a chunk's edits (kind 0), then its rows."""
    conv, place, state, pending = None, 0, 0, ""
    for batch in batches:
        out = []

        def inserted():
            nonlocal place, state, pending
            while pending.startswith("I"):
                wanted = WANTED[state]
                place, state, pending = place + 1, AFTER[state][wanted], pending[1:]
                out.append((conv, place, "I", None, ROLES[wanted], ""))

        for name, kind, start, edits, turn, role, text in zip(*(batch.column(c).to_pylist() for c in range(7))):
            if kind == 0:
                if name != conv:
                    conv, place = name, 0
                state, pending = start, edits
            else:
                edit, pending = pending[0], pending[1:]
                if edit != "D":
                    role = role if edit == "K" else ROLES[WANTED[state]]
                    place, state = place + 1, AFTER[state][role[0]]
                    out.append((conv, place, edit, turn, role, text))
            inserted()
        if out:
            types = (pa.string(), pa.int64(), pa.string(), batch.schema.field("turn").type, pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             names=["conv", "place", "edit", "turn", "role", "text"])


def _turns(rows: DataFrame, traced: DataFrame) -> DataFrame:
    kind = rows.schema["turn"].dataType.simpleString()
    said = rows.select("conv", "chunk", F.lit(1).alias("kind"), "pos", F.lit(0).alias("state"), F.lit("").alias("edits"), "turn", "role", "text")
    edits = traced.select("conv", "chunk", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("pos"), "state", "edits",
                          F.lit(None).cast(kind).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    stream = said.unionByName(edits).repartition("conv").sortWithinPartitions("conv", "chunk", "kind", "pos")
    return stream.select("conv", "kind", "state", "edits", "turn", "role", "text").mapInArrow(
        _repaired, f"conv string, place long, edit string, turn {kind}, role string, text string")


def repair(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(report, turns) of conversations (conv_id, turn, role, text).

    ``report``: conv (the id as text, a space if null), gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``turns``: the repaired conversations (conv, place, edit, turn, role, text); a conversation's turns are in one
    partition, one after the other, in order.
    """
    ordered = _ordered(rows, scratch)
    faults = scratch.write(_with_duplicates(ordered), "faults")
    chunks = scratch.write(_symbols(faults), "chunks")
    scanned = scratch.write(_scanned(_summaries(chunks)), "scanned")
    traced = scratch.write(_traced(chunks, scanned), "traced")

    def total(c: str) -> Column:
        return F.sum(c).cast("long").alias(c)

    counts = faults.groupBy("conv").agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")])
    turn = F.col("turn")
    spans = ordered.select("conv", "turn").where(turn.isNotNull()).distinct().groupBy("conv").agg(
        (F.max(turn) - F.min(turn) + 1 - F.count("*")).cast("long").alias("gaps"))
    costs = scanned.groupBy("conv").agg(total("illegal"), total("cost"))
    # the pieces of one value of the result
    audits = traced.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("chunk", "edits"))).alias("pieces")).select(
        "conv", F.array_join("pieces.edits", "").alias("audit"))
    report = None
    for part in (counts, spans, costs, audits):
        report = part if report is None else report.unionByName(part, allowMissingColumns=True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    report = report.groupBy("conv").agg(*[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in numbers], F.max("audit").alias("audit"))
    return report, _turns(ordered, traced)


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the turns of ``repair``, as their order is: `role:text` joined by line ends, streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def put_out(done):
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.string()), pa.array([v for _, v in done], pa.string())],
                                              names=["conv", "repaired_sha256"])

        for batch in batches:
            done = []
            for name, role, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if name != conv:
                    if conv is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = name, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield put_out(done)
        if conv is not None:
            yield put_out([(conv, state.hexdigest())])

    return turns.select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of id and turn."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    marked = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), key.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "repair")
    conversations = table(spark, sf_dir, "conversations")
    report, turns = repair(damaged(conversations), scratch)
    every = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    whole = every.unionByName(report, allowMissingColumns=True).unionByName(digests(turns), allowMissingColumns=True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.groupBy("conv").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")).select(
        F.when(F.col("conv") != " ", F.col("conv")).cast(conversations.schema["conv_id"].dataType).alias("conv_id"),
        *numbers, "audit", "repaired_sha256")


def _oracle() -> str:
    """A forward search that keeps, for each state, the cheapest and then ASCII-least edits, with what they give."""
    def step(state: str, cost: str, letter: str, said: str = "''", allowed: str = "true") -> str:
        return (f"struct_pack(c := CASE WHEN {allowed} THEN {state}.c + {cost} ELSE 1000000000 END, "
                f"a := {state}.a || '{letter}', r := {state}.r || {said})")

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    live = "NOT must_go"

    def row(state: str, froms: dict[str, str], role: str | None) -> str:
        """Best ways into a state: a deleted row, a kept one, one with a new role."""
        ways = [step(state, "3", "D")]
        for source, initial in froms.items():
            ways.append(step(source, "extra", "K", "chr(10) || role || ':' || text", f"{live} AND starts_with(role, '{initial}')"))
            if role:
                ways.append(step(source, "2 + extra", "R", f"chr(10) || '{role}:' || text", live))
        return f"list_min([{', '.join(ways)}])"

    inserts_u = f"list_min([u, {step('n', '2', 'I', user)}, {step('s', '2', 'I', user)}, {step('a', '2', 'I', user)}])"
    inserts_a = f"list_min([a, {step('gu', '2', 'I', assistant)}])"
    none = "struct_pack(c := 1000000000::BIGINT, a := '', r := '')"
    return f"""
WITH RECURSIVE shown AS (
    SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') AS conv, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations),
checked AS (
    SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(key, ''), lambda s: ascii(s)::BIGINT),
        lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS fault
    FROM shown),
damaged AS (
    SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM checked WHERE fault <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
seen AS (
    SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open_end,
           lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair
    FROM placed),
faults AS (
    SELECT conv, turn, role, text, i, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND open_end AS truncated,
           blank OR again AS must_go, CASE WHEN NOT blank AND NOT again AND open_end THEN 1 ELSE 0 END AS extra,
           coalesce(pair NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM seen),
walk AS (
    SELECT conv, 0::BIGINT AS i, struct_pack(c := 0::BIGINT, a := '', r := '') AS n, {none} AS s, {none} AS u, {none} AS a
    FROM (SELECT DISTINCT conv FROM shown)
    UNION ALL
    SELECT conv, i + 1, {row('n', {}, None)}, {row('s', {'n': 's'}, None)},
           {row('gu', {'n': 'u', 's': 'u', 'ga': 'u'}, 'user')}, {row('ga', {'gu': 'a'}, 'assistant')}
    FROM (SELECT *, {inserts_a} AS ga
          FROM (SELECT w.*, f.role, f.text, f.must_go, f.extra, {inserts_u} AS gu
                FROM walk w JOIN faults f ON f.conv = w.conv AND f.i = w.i + 1))),
ended AS (
    SELECT conv, list_min([n, ga]) AS best
    FROM (SELECT *, {inserts_a} AS ga
          FROM (SELECT *, {inserts_u} AS gu FROM walk QUALIFY row_number() OVER (PARTITION BY conv ORDER BY i DESC) = 1))),
counts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::BIGINT) AS blank,
           sum(duplicate::BIGINT) AS duplicate, sum(truncated::BIGINT) AS truncated, sum(illegal::BIGINT) AS illegal
    FROM faults GROUP BY conv)
SELECT nullif(e.conv, ' ')::BIGINT AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv = e.conv
"""


ORACLE = _oracle()
