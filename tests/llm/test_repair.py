import hashlib
import itertools
import random
import re
import zlib

import pytest

from cartlake.llm import registry, repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, block int, at int, n long"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def broken(rows):
    """Rows (turn, role, text) of each conversation after the damage."""
    found = {}
    for conv, turn, role, text in rows:
        mine = found.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        said = ":".join(" " if v is None else str(v) for v in (conv, turn))
        mark = zlib.crc32(said.encode()) % 20
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        role = "user" if mark == 4 else role
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(mark, 1)
    for mine in found.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return found


def brute(rows):
    """Whole audits and texts carried along, state by state."""
    out = {}
    for conv, mine in broken(rows).items():
        blank = duplicate = truncated = 0
        best = {"": (0, "", ())}

        def insert(best):
            for _ in range(3):
                for p in list(best):
                    cost, audit, lines = best[p]
                    new = (cost + 3, audit + "I", (*lines, FULL[NEXT[p]] + ":"))
                    if NEXT[p] not in best or new < best[NEXT[p]]:
                        best[NEXT[p]] = new
            return best

        for i, (_, role, text) in enumerate(mine):
            shown = text.strip(" \t\n\x0b\f\r")
            is_blank = not shown
            is_duplicate = not is_blank and (role, text) in [(r, t) for _, r, t in mine[:i]]
            is_late = not is_blank and not is_duplicate and shown[-1] not in ".!?"
            blank, duplicate, truncated = blank + is_blank, duplicate + is_duplicate, truncated + is_late
            after = {}
            for p, (cost, audit, lines) in every_insert(best):
                choices = [(p, cost + 4, "D", lines)]
                if not (is_blank or is_duplicate):
                    late = 3 * is_late
                    choices.append((NEXT[p], cost + 3 + late, "R", (*lines, f"{FULL[NEXT[p]]}:{text}")))
                    first = role[:1]
                    if first == NEXT[p] or (first == "s" and p == ""):
                        choices.append((first, cost + late, "K", (*lines, f"{role}:{text}")))
                for q, c, letter, l in choices:
                    if q not in after or (c, audit + letter) < after[q][:2]:
                        after[q] = (c, audit + letter, l)
            best = after
        cost, audit, lines = min(v for p, v in every_insert(best) if p in ("", "a"))
        firsts = [r[:1] for _, r, _ in mine]
        turns = [t for t, _, _ in mine if t is not None]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            blank, duplicate, truncated,
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(firsts)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def every_insert(best):
    for p, (cost, audit, lines) in best.items():
        for _ in range(4):
            yield p, (cost, audit, lines)
            cost, audit, lines = cost + 3, audit + "I", (*lines, FULL[NEXT[p]] + ":")
            p = NEXT[p]


def conversations():
    rng = random.Random(11)
    stock = ["Fine.", "So be it", "ok!", "", " \t", "Why?", "no. ", "Long " * 30 + ".", "é.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 12)):
            place = None if rng.random() < 0.1 else turn + 5 * (rng.random() < 0.1)
            text = rng.choice(stock) if rng.random() < 0.4 else f"say {conv} {turn}" + rng.choice(".!?,")
            rows.append((conv, place, rng.choice(roles), text))
    rows += [rows[3]] * 5 + [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None)]
    # One conversation holds a third of all rows, most of them equal.
    rows += [(500, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(150)] + [(500, 7, "user", "again.")] * 250
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4) for r in conversations()], SCHEMA).repartition(5)


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize("rows", [repair.ROWS, 7])
def test_equals_search_over_whole_audits(table, rows):
    got = as_dict(repair.repaired(table, rows=rows))
    want = brute(conversations())
    assert got == want


def test_small_blocks_by_bytes(table):
    assert as_dict(repair.repaired(table, size=40)) == brute(conversations())


def test_empty_and_odd_tables(spark, table):
    assert repair.repaired(table.limit(0)).count() == 0
    # All rows of a conversation dropped: zeros and the hash of nothing.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repaired(spark.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn long, role string, text string")).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_tables_of_runs_compose():
    rng = random.Random(2)
    for _ in range(200):
        codes = bytes(rng.randrange(9) for _ in range(rng.randint(1, 12)))
        at = rng.randint(0, len(codes))
        halves = [repair.run_table(codes[:at]), repair.run_table(codes[at:])]
        for p in repair.STATES:
            vector = repair.point(p)
            for half in halves:
                vector = repair.forth(vector, half)
            assert vector[0] == repair.run_table(codes)[0][p]


def test_query_reads_whole_table(spark):
    got = as_dict(registry.queries()["op11_conversation_repair"](spark, SF))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)
