import random

from cartlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place int, part int, a long"


def brute(rows):
    steps = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            key = (turn is None, turn or 0)
            steps.setdefault(conv, {}).setdefault(key, set()).add((role, text))
    whole = {c: tuple(frozenset(s[k]) for k in sorted(s)) for c, s in steps.items()}
    kept = {}
    for c, s in whole.items():
        if any(len(o) > len(s) and o[: len(s)] == s for o in whole.values()):
            continue
        if any(o == s and d < c for d, o in whole.items()):
            continue
        lines = []
        for k in sorted(steps[c]):
            for role, text in sorted((r or "", t or "") for r, t in steps[c][k]):
                lines.append(f"<|{role}|>\n{text}\n")
        kept[c] = len(s), len(lines), "".join(lines)
    return kept


def logs():
    rng, rows = random.Random(6), []
    for c in range(12):
        base = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "no", "", None, "yes\nno"])) for _ in range(rng.randint(1, 6))]
        for k in range(1, len(base) + 1):
            if rng.random() < 0.7:
                rows += [(c * 10 + k, 2 * t, *base[t]) for t in range(k)]
    rows += rows[:5]  # repeats
    rows += [(500, None, "user", "late"), (500, 1, "user", "x"), (500, 1, "user", "y"), (None, 1, "user", "gone"), (501, None, None, None)]
    rows += [(700, t, "user", f"t{t % 7}") for t in range(3000)] + [(701, t, "user", f"t{t % 7}") for t in range(2500)]
    return rows


def test_as_brute_force(spark):
    rows = logs()
    table = spark.createDataFrame([(*r, 9, 9, 9) for r in rows], SCHEMA).repartition(3)
    parts = {}
    for r in chat.render(table).collect():
        parts.setdefault(r["conv_id"], []).append((r["part"], r["n_steps"], r["n_turns"], r["rendered"]))
    got = {c: (p[0][1], sum(x[2] for x in p), "".join(x[3] for x in sorted(p))) for c, p in parts.items()}
    assert got == brute(rows)
    assert len(parts[700]) == 3 and 701 not in parts


def test_no_rows(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).collect() == []
