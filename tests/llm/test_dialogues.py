"""Repairs of conversations against a search through all edits, and against plain Python over whole tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from folioforge.llm import catalog, dialogues
from folioforge.llm.dialogues import Costs

SHAPE = re.compile("(s?(ua)+)?")


def cheapest(signature: str, costs: Costs) -> tuple[int, str]:
    """Tries every edit of every turn with up to two insertions at each place."""
    found = []

    def go(i: int, cost: int, letters: str, audit: str) -> None:
        if i == len(signature):
            for k in range(3):
                for new in itertools.product("ua", repeat=k):
                    if SHAPE.fullmatch(letters + "".join(new)):
                        found.append((cost + k * costs.insert, audit + "I" * k))
            return
        fault, kind = divmod(dialogues.SYMBOLS.index(signature[i]), 4)
        for k in range(3):
            for new in itertools.product("ua", repeat=k):
                spent, so_far, done = cost + k * costs.insert, letters + "".join(new), audit + "I" * k
                go(i + 1, spent + costs.delete, so_far, done + "D")
                if fault in (0, 1):
                    stay = spent + (costs.truncated if fault else 0)
                    if kind < 3:
                        go(i + 1, stay, so_far + "suao"[kind], done + "K")
                    for letter in "ua":
                        go(i + 1, stay + costs.rerole, so_far + letter, done + "R")

    go(0, 0, "", "")
    return min(found)


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 7, 1, 1), Costs(3, 2, 1, 0), Costs(2, 2, 2, 1)])
def test_cheapest_audit(costs):
    rng = random.Random(3)
    signatures = ["".join(rng.choice("suaoSUAO0137") for _ in range(n)) for n in (1, 2, 3) for _ in range(25)]
    solve = dialogues.solver(costs)
    for signature in signatures:
        ends = [(cost + costs.insert * len(dialogues.CLOSING[j]), audit + "I" * len(dialogues.CLOSING[j])) for (i, j), (cost, audit) in solve(signature).items() if i == 0]
        assert min(ends) == cheapest(signature, costs), signature


def expected(rows, damage: bool, solve) -> dict:
    """What op11's contract says of (conv, turn, role, text)."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        by[conv] += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, signature, faults = set(), "", []
        for _, role, text in turns:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 2 if not visible else 3 if (role, text) in seen else 1 if visible[-1] not in ".!?" else 0
            seen.add((role, text))
            faults.append(fault)
            kind = "sua".find(role[:1]) if role else -1
            signature += dialogues.SYMBOLS[(kind if kind >= 0 else 3) + 4 * fault]
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        wrong = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit = solve(signature) if signature else (0, "")
        lines, i, state = [], 0, "0"
        for e in audit:
            if e == "I":
                state = "a" if state == "u" else "u"
                lines.append(("user" if state == "u" else "assistant") + ":")
                continue
            if e == "K":
                state = turns[i][1][0]
                lines.append(f"{turns[i][1]}:{turns[i][2]}")
            elif e == "R":
                state = "a" if state == "u" else "u"
                lines.append(("user" if state == "u" else "assistant") + ":" + turns[i][2])
            i += 1
        out[conv] = (gaps, faults.count(2), faults.count(3), faults.count(1), wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def forward(costs: Costs):
    """The best audit by states from left to right."""

    def solve(signature: str) -> tuple[int, str]:
        one = dialogues.solver(costs)
        best = {0: (0, "")}
        for symbol in signature:
            new = {}
            for (i, j), (cost, audit) in one(symbol).items():
                if i in best:
                    new.setdefault(j, []).append((best[i][0] + cost, best[i][1] + audit))
            best = {j: min(x) for j, x in new.items()}
        return min((c + costs.insert * len(dialogues.CLOSING[j]), a + "I" * len(dialogues.CLOSING[j])) for j, (c, a) in best.items())

    return solve


SCHEMA = "conv_id long, turn long, role string, text string"


def found(spark, rows, costs=Costs(), **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = dialogues.repair(df, costs=costs, **options)
    hashes = {r["conv"]: r["sha256"] for r in dialogues.digests(made.turns()).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (*(r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")), hashes.get(r["conv"], empty)) for r in made.audits.collect()}


def random_rows(rng, conv, n):
    texts = ["Yes.", "No!", "Why?", "so then", "", " \t", "A. b", None]
    return [(conv, None if rng.random() < 0.1 else t + rng.randrange(2), rng.choice(["user", "assistant", "system", "tool", None, ""]) if rng.random() < 0.4 else ("user", "assistant")[t % 2], rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randrange(n)}.") for t in range(n)]


@pytest.mark.parametrize("costs", [Costs(), Costs(3, 7, 1, 1)])
def test_segments_give_what_whole_conversations_give(spark, costs):
    """Long conversations in short segments, nulls in every column, ties, many copies of one turn, a conversation without an id."""
    rng = random.Random(5)
    rows = [r for conv, n in ((1, 230), (2, 1), (3, 40), (None, 60), (7, 9)) for r in random_rows(rng, conv, n)]
    rows += [(3, 5, "user", "Again and again.")] * 90 + [(3, 6, "assistant", " ")] * 40 + [(9, None, None, None)] * 3
    assert found(spark, rows, costs, segment=8) == expected(rows, False, forward(costs))


def test_whole_table_with_damage(spark):
    got = {r[0]: tuple(r)[1:] for r in catalog.op11_dialogues(spark, "/root/testdata/sf0.01").collect()}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == expected(rows, True, forward(Costs()))


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == {}
    rows = spark.createDataFrame([(1, 1, "user", "Hi.", "x", 5, "y"), (1, 2, "assistant", "Yes.", "x", 5, "y")], SCHEMA + ", digest string, seg int, signature string")
    assert [r["audit"] for r in dialogues.repair(rows).audits.collect()] == ["KK"]


def test_costs_must_be_positive():
    with pytest.raises(ValueError, match="cost"):
        Costs(insert=0)
