"""Conversations brought back to alternating turns, at the least cost.

Each turn is one symbol: the class of its role's first letter (system, user, assistant, other) and its first fault
(blank: nothing but white space; duplicate: its role and text stand in an earlier turn; truncated: its last visible
character ends no sentence). A conversation's symbols, in order, are its signature; each distinct signature is solved
once and its audit is joined back to the conversations that have it.

An audit has a letter for each edit: K keeps a turn, R gives it the role user or assistant, D deletes it, I inserts an
empty turn. The letters of the resulting roles make `(s?(ua)+)?`. The cheapest audit is taken, of equal ones the first
in ASCII order. A signature is solved by memoised recursion on its halves: the answer of a part is, for each pair of
states of that grammar, the best (cost, letters) that leads from one to the other. Inserted turns count to the turn
behind them, so no two answers of the same part are each other's beginnings, and the order of parts is that of wholes.

Long conversations are cut into segments of SEGMENT turns where they lie in ranges of (conversation, turn), so no task
orders a whole conversation; their segments' costs, a few numbers each, are folded from last to first. Equal turns
(same conversation, turn, role and text) are counted before they are dealt out. Texts move only for the result.

Order: by turn, nulls first; turns with the same number by role, then by the text's digest. A null role or text is one
space (so blank). A null conversation id is an id of its own. A role that begins with none of s, u, a (or is empty)
can't be kept. Extra columns are ignored. An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, small_batches

#: Turns of a segment.
SEGMENT = 2048
#: Parts up to this length are remembered, and so many of them.
REMEMBERED, PARTS = 64, 1 << 14
#: The place of what stands behind all turns of a segment, or all insertions before a turn.
BEHIND = (1 << 31) - 1
#: Role classes, and symbols: a class's place and four times the place of its fault.
CLASSES = "suao"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
SYMBOLS = "suaoSUAO01234567"
#: Pairs of neighbouring role classes that are legal.
LEGAL = {"su", "ua", "au"}
#: States of the grammar: nothing yet, behind the system's turn, the user's, the assistant's. Which follows on a letter.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Edits that end a conversation properly, by state.
CLOSING = ("", "ua", "a", "")
VISIBLE, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


@dataclass(frozen=True)
class Costs:
    """What edits cost; all more than 0, but for keeping, which is free. A truncated turn that stays costs `truncated` more."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self) -> None:
        if min(self.rerole, self.delete, self.insert) <= 0 or self.truncated < 0:
            raise ValueError("edits must cost something")


def inserted(state: int) -> Iterator[tuple[int, str]]:
    """States that inserted turns lead to, with these turns' letters; more than two lead to none of them cheaper."""
    letters = ""
    for _ in range(3):
        yield state, letters
        letter = "a" if state == USER else "u"
        state, letters = NEXT[state, letter], letters + letter


def solver(costs: Costs = Costs()):  # noqa: B008
    """A function from a signature to {(state before, state behind): (cost, audit)}."""

    def single(symbol: str) -> dict[tuple[int, int], tuple[int, str]]:
        fault, kind = divmod(SYMBOLS.index(symbol), 4)
        best: dict[tuple[int, int], tuple[int, str]] = {}

        def offer(before: int, behind: int, cost: int, audit: str) -> None:
            best[before, behind] = min(best.get((before, behind), (cost, audit)), (cost, audit))

        for before in range(4):
            for state, letters in inserted(before):
                spent, done = costs.insert * len(letters), "I" * len(letters)
                offer(before, state, spent + costs.delete, done + "D")
                if fault in (FINE, TRUNCATED):
                    stays = spent + (costs.truncated if fault == TRUNCATED else 0)
                    for letter in "sua":
                        if (state, letter) in NEXT:
                            if CLASSES[kind] == letter:
                                offer(before, NEXT[state, letter], stays, done + "K")
                            if letter != "s":
                                offer(before, NEXT[state, letter], stays + costs.rerole, done + "R")
        return best

    def joined(signature: str) -> dict[tuple[int, int], tuple[int, str]]:
        if len(signature) == 1:
            return single(signature)
        half = 1 << ((len(signature) - 1).bit_length() - 1)
        best: dict[tuple[int, int], tuple[int, str]] = {}
        second: list[list[tuple[int, int, str]]] = [[], [], [], []]
        for (middle, behind), (cost, audit) in solve(signature[half:]).items():
            second[middle].append((behind, cost, audit))
        for (before, middle), (cost, audit) in solve(signature[:half]).items():
            for behind, more, rest in second[middle]:
                known = best.get((before, behind))
                if known is None or (cost + more, audit + rest) < known:
                    best[before, behind] = cost + more, audit + rest
        return best

    short = lru_cache(PARTS)(joined)
    solve = lambda signature: short(signature) if len(signature) <= REMEMBERED else joined(signature)
    return solve


def replayed(state: int, signature: str, audit: str) -> tuple[str, list[str]]:
    """What an audit does: a letter for each turn (k: as it is, u or a: its new role, -: gone), and what is inserted, as `place letter`."""
    turns, new, at = [], [], 0
    for edit in audit:
        if edit == "I":
            letter = "a" if state == USER else "u"
            new.append(f"{at} {letter}")
            state = NEXT[state, letter]
            continue
        if edit == "D":
            turns.append("-")
        else:
            letter = CLASSES[SYMBOLS.index(signature[at]) % 4] if edit == "K" else "a" if state == USER else "u"
            turns.append("k" if edit == "K" else letter)
            state = NEXT[state, letter]
        at += 1
    return "".join(turns), new


def illegal(first: str, second: str) -> bool:
    pair = "".join(CLASSES[SYMBOLS.index(x) % 4] for x in (first, second))
    return pair not in LEGAL


def faults(role: Column, text: Column) -> Column:
    """The fault that a turn shows by itself."""
    return F.when(~text.rlike(VISIBLE), BLANK).when(~text.rlike(ENDED), TRUNCATED).otherwise(FINE)


def plain(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest) without nulls in role and text."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), some(role).alias("role"), some(text).alias("text")).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


KEYS = ["conv", "turn", "role", "digest"]


def same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null; the right side's keys go."""
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k].eqNullSafe(named[f"_{k}"]) for k in keys]
    return left.join(named, on, how).drop(*[f"_{k}" for k in keys])


def segments(turns: DataFrame, most: int = SEGMENT) -> DataFrame:
    """The turns in order, without texts, and behind each segment's turns a row with its signature.

    A turn's row: its keys, seg (ascending) and at, its place in it; a segment's: conv, seg and signature.
    """
    copies = turns.withColumn("state", faults(F.col("role"), F.col("text"))).groupBy(*KEYS).agg(F.max("state").alias("state"), F.count("*").alias("n"))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    # n is always more than 0; it's asked for so that both uses of the copies read the same shuffle
    firsts = copies.where((F.col("state") != BLANK) & (F.col("n") > 0)).groupBy("conv", "role", "digest").agg(F.min(place).alias("first"))
    known = same(copies, firsts, ["conv", "role", "digest"], "left")
    state = F.when((F.col("state") != BLANK) & (place != F.col("first")), DUPLICATE).otherwise(F.col("state"))
    kind = F.instr(F.lit(CLASSES[:3]), F.substring("role", 1, 1))
    kind = F.when((kind > 0) & (F.col("role") != ""), kind - 1).otherwise(3)
    # a copy of a blank turn is blank, any other copy a duplicate
    again = F.when(F.col("state") == BLANK, BLANK).otherwise(DUPLICATE)
    symbol = lambda fault: F.substr(F.lit(SYMBOLS), kind + fault * 4 + 1, F.lit(1))
    rows = known.select(*KEYS, symbol(state).alias("symbol"), symbol(again).alias("more"), "n").repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    types = dict(turns.dtypes)
    schema = f"conv {types['conv']}, turn {types['turn']}, role string, digest binary, seg long, at int, signature string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, filled, last, begun = TaskContext.get().partitionId() << 40, [], None, False
        length = 0
        out: list[tuple] = []

        def close() -> None:
            nonlocal seg, length
            if length:
                out.append((last, None, None, None, seg, None, "".join(filled)))
                filled.clear()
                seg, length = seg + 1, 0

        def flushed(target: pa.Schema) -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), target, strict=True)], schema=target)
            out.clear()
            return made

        target = None
        for batch in batches:
            if target is None:
                of = lambda k: batch.schema.field(k).type  # noqa: B023, E731
                target = pa.schema([("conv", of("conv")), ("turn", of("turn")), ("role", of("role")), ("digest", of("digest")), ("seg", pa.int64()), ("at", pa.int32()), ("signature", pa.string())])
            for conv, turn, role, digest, symbol, more, n in zip(*(batch.column(k).to_pylist() for k in (*KEYS, "symbol", "more", "n")), strict=True):
                if not begun or conv != last or length >= most:
                    close()
                    begun, last = True, conv
                out.append((conv, turn, role, digest, seg, length, None))
                filled.append(symbol)
                length += 1
                n -= 1
                while n:
                    if length >= most:
                        close()
                    now = min(n, most - length)
                    filled.append(more * now)
                    length, n = length + now, n - now
                    if len(out) >= SEGMENT:
                        yield flushed(target)
            if out:
                yield flushed(target)
        close()
        if out:
            yield flushed(target)

    return rows.mapInArrow(cut, schema)


SOLVED = "signature string, costs array<bigint>, ranks array<int>, audits array<string>, made array<string>, new array<array<string>>, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def solved(signatures: DataFrame, costs: Costs) -> DataFrame:
    """Of each distinct signature its faults and, for each pair of states, the cheapest audit, what it costs and does, and its place among them in ASCII order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = solver(costs)
        for batch in batches:
            rows = []
            for signature in batch.column(0).to_pylist():
                best = solve(signature)
                order = {a: i for i, a in enumerate(sorted(a for _, a in best.values()))}
                row: list[list] = [[], [], [], [], []]
                for before in range(4):
                    for behind in range(4):
                        cost, audit = best.get((before, behind), (None, None))
                        turns, new = replayed(before, signature, audit) if audit is not None else (None, None)
                        for part, value in zip(row, (cost, order.get(audit), audit, turns, new), strict=True):
                            part.append(value)
                found = [sum(SYMBOLS.index(x) // 4 == f for x in signature) for f in (BLANK, DUPLICATE, TRUNCATED)]
                rows.append((signature, *row, *found, sum(map(illegal, signature, signature[1:]))))
            if rows:
                types = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.list_(pa.string())), *[pa.int64()] * 4]
                names = [x.split(" ")[0] for x in SOLVED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return signatures.distinct().mapInArrow(work, SOLVED)


def ways(graded: DataFrame, costs: Costs) -> DataFrame:
    """(seg, way, closing, extra, across) of every segment: which of its audits its conversation takes (by the place of the pair of states), the letters inserted behind it, what they cost, and whether its border to the next is illegal.

    A conversation's segments come in order, the last first; of each only the choices (a byte for each state) are kept.
    """
    slim = graded.select("conv", "seg", "costs", "ranks", F.substring("signature", 1, 1).alias("head"), F.substring("signature", -1, 1).alias("tail"))
    rows = slim.repartition("conv").sortWithinPartitions("conv", F.desc("seg"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, begun = None, False
        choices, segs, across = bytearray(), [], []
        later: list[int] = []
        after = ""

        def ended() -> Iterator[pa.RecordBatch]:
            state, out = START, ([], [], [], [], [])
            for i in range(len(segs) - 1, -1, -1):
                behind = choices[4 * i + state]
                letters = "" if i else CLOSING[behind]
                for part, value in zip(out, (segs[i], 4 * state + behind, letters, costs.insert * len(letters), across[i]), strict=True):
                    part.append(value)
                state = behind
            if segs:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["seg", "way", "closing", "extra", "across"])
            choices.clear()
            segs.clear()
            across.clear()

        for batch in batches:
            for conv, seg, cost, rank, head, tail in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if not begun or conv != last:
                    yield from ended()
                    begun, last, after = True, conv, ""
                    later = [costs.insert * len(x) for x in CLOSING]
                now = []
                for before in range(4):
                    open_ = [(cost[4 * before + j] + later[j], rank[4 * before + j], j) for j in range(4) if cost[4 * before + j] is not None]
                    least = min(open_)
                    choices.append(least[2])
                    now.append(least[0])
                later = now
                segs.append(seg)
                across.append(int(bool(after) and illegal(tail, after)))
                after = head
        yield from ended()

    return rows.mapInArrow(fold, "seg long, way int, closing string, extra long, across long")


@dataclass(frozen=True)
class Repair:
    """What `repair` found."""

    audits: DataFrame
    _rows: DataFrame
    _graded: DataFrame
    _texts: DataFrame

    def turns(self) -> DataFrame:
        """(conv, seg, at, k, role, text) of the repaired conversations; (seg, at, k) is a turn's place."""
        made = self._graded.select("seg", F.get("made", "way").alias("made"))
        role = F.when(F.col("edit") == "u", "user").when(F.col("edit") == "a", "assistant").otherwise(F.col("role"))
        kept = self._rows.join(made, "seg").withColumn("edit", F.substr("made", F.col("at") + 1, F.lit(1))).where("edit != '-'").select(*KEYS, "seg", "at", role.alias("new_role"))
        # a turn that stays is one row, its copies in the table are many: they are dropped where the join has put them
        found = same(kept, self._texts, KEYS).groupBy(*KEYS, "seg", "at", "new_role").agg(F.first("text").alias("text"))
        named = lambda letter: F.when(letter == "u", "user").otherwise("assistant")
        new = self._graded.select("conv", "seg", F.posexplode(F.get("new", "way")).alias("k", "x")).select("conv", "seg", F.split_part("x", F.lit(" "), F.lit(1)).cast("int").alias("at"), "k", named(F.split_part("x", F.lit(" "), F.lit(2))).alias("role"))
        end = self._graded.where("closing != ''").select("conv", "seg", F.posexplode(F.split("closing", "")).alias("k", "x")).select("conv", "seg", F.lit(BEHIND).alias("at"), "k", named(F.col("x")).alias("role"))
        stays = found.select("conv", "seg", "at", F.lit(BEHIND).alias("k"), F.col("new_role").alias("role"), "text")
        return stays.unionByName(new.unionByName(end).withColumn("text", F.lit("")))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: Costs = Costs(), segment: int = SEGMENT) -> Repair:  # noqa: B008
    """Audits of all conversations: conv, blank, duplicate, truncated, illegal, cost, audit, and gaps (numbers missing between the least and the greatest turn, whose type must be integral)."""
    spark = rows.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    texts = plain(rows, conv, turn, role, text)
    cut = scratch.write(segments(texts, segment))
    turns = cut.where("signature is null").drop("signature")
    parts = cut.where("signature is not null").select("conv", "seg", "signature")
    graded = scratch.write(parts.join(solved(parts.select("signature"), costs), "signature"))
    taken = scratch.write(graded.join(ways(graded, costs), "seg"))
    total = lambda *c: F.sum(sum((F.col(x) for x in c), F.lit(0))).cast("bigint")
    piece = F.concat(F.get("audits", "way"), F.repeat(F.lit("I"), F.length("closing")))
    pieces = F.array_sort(F.collect_list(F.struct("seg", piece.alias("piece"))))
    audits = taken.withColumn("spent", F.get("costs", "way")).groupBy("conv").agg(
        *[total(x).alias(x) for x in ("blank", "duplicate", "truncated")], total("illegal", "across").alias("illegal"), total("spent", "extra").alias("cost"), F.array_join(F.transform(pieces, lambda x: x["piece"]), "").alias("audit")
    )
    spans = turns.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    return Repair(same(audits, spans, ["conv"]), turns, taken, texts)


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256): of each repaired conversation the hash of its lines `role:text`. Sorted rows stream through the hash, which can't be split, so no conversation is held."""
    rows = turns.select("conv", "seg", "at", "k", F.concat_ws(":", "role", "text").alias("line")).repartition("conv").sortWithinPartitions("conv", "seg", "at", "k").select("conv", "line")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        last, state, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            done: list[tuple] = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or conv != last:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    last, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done], pa.string())], names=["conv", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], kind), pa.array([state.hexdigest()], pa.string())], names=["conv", "sha256"])

    return rows.mapInArrow(work, f"conv {dict(turns.dtypes)['conv']}, sha256 string")
