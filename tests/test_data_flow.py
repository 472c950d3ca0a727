"""Reaching definitions against an evaluation of nested statements, and in bounded memory."""

import random
import tracemalloc
from collections import Counter

from arborflow.operators.reaching import reaching_pairs


def random_block(pick, depth, numbers):
    """Nested statements: ("def", id), ("use", id), ("if", number, arm, arm), ("loop", number, body)."""
    out = []
    for _ in range(pick.randint(0 if depth else 2, 5)):
        kind = pick.choice(["def", "use", "use", "if", "loop"] if depth < 4 else ["def", "use"])
        number = next(numbers)
        if kind in ("def", "use"):
            out.append((kind, f"{kind}{number}"))
        elif kind == "if":
            out.append(("if", number, random_block(pick, depth + 1, numbers), random_block(pick, depth + 1, numbers)))
        else:
            out.append(("loop", number, random_block(pick, depth + 1, numbers)))
    return out


def events_of(block, frames=()):
    for statement in block:
        if statement[0] in ("def", "use"):
            yield statement[0], statement[1], list(frames)
        elif statement[0] == "if":
            for arm, body in zip(("then", "else"), statement[2:]):
                yield from events_of(body, (*frames, (statement[1], arm)))
        else:
            yield from events_of(statement[2], (*frames, (statement[1], "loop")))


def evaluated(block, reach, pairs):
    for statement in block:
        if statement[0] == "def":
            reach = {statement[1]}
        elif statement[0] == "use":
            pairs |= {(d, statement[1]) for d in reach}
        elif statement[0] == "if":
            reach = evaluated(statement[2], reach, pairs) | evaluated(statement[3], reach, pairs)
        else:
            while (after := reach | evaluated(statement[2], reach, pairs)) != reach:
                reach = after
    return reach


def test_pairs_equal_an_evaluation():
    some = 0
    for seed in range(1_500):
        pick = random.Random(seed)
        block, want = random_block(pick, 0, iter(range(10_000))), set()
        evaluated(block, set(), want)
        found = Counter(reaching_pairs(events_of(block)))
        assert found == Counter(want), block
        some += len(want)
    assert some > 5_000


def test_a_function_of_100_000_statements_in_little_memory():
    def straight():
        for i in range(50_000):
            yield "def", f"d{i}", []
            yield "use", f"u{i}", [(i, "then")]

    def guarded():
        """Definitions that replace nothing, one use at the end; all in a loop whose head looks back."""
        yield "use", "head", [("", "loop")]
        for i in range(100_000):
            yield "def", f"d{i}", [("", "loop"), (i, "then")]
        yield "use", "end", [("", "loop")]

    numbered = lambda events: ((k, n, [(-1 if s == "" else s, a) for s, a in f]) for k, n, f in events)
    tracemalloc.start()
    assert sum(1 for _ in reaching_pairs(straight())) == 50_000
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    assert sum(1 for _ in reaching_pairs(numbered(guarded()))) == 200_000
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()
