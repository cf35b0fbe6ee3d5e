import random
import re
from itertools import groupby

import duckdb
import pandas as pd

from cartlake.llm import license

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_as_brute_force(docs, rows):
    got = {r["doc_id"]: r for r in license.scan(docs).collect()}
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        found = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        r = got[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(words), len(found))
        assert (r["first_word"], r["last_word"]) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in found}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert (r["score"] == 1.0) >= bool(found)
    assert sum(r["n_base"] for r in got.values()) >= 4


def test_words_between_do_not_hide_a_notice(spark):
    text = "Redistribution and use, in source and also binary forms, with or without any modification, are permitted"
    rows = [(1, text), (2, "use in source"), (3, "Licensed under CC BY-NC 4.0"), (4, "general public general public license")]
    got = {r["doc_id"]: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "bsd" and 0.8 < got[1]["score"] < 1
    assert got[2]["labels"] == ""
    assert got[3]["labels"] == "cc-by,cc-by-nc"
    assert (got[4]["n_base"], got[4]["first_word"]) == (1, 2)


def test_repeated_pairs_are_no_notice(spark):
    notice = "this work is licensed under the GNU General Public License, version 3"
    rows = [
        (1, "Licensed under CC BY, CC-BY 4.0"), (2, "cc by " * 5), (3, "Licensed under CC BY-SA 4.0"), (4, "4.0 SA by cc under licensed"),
        (5, "cc by nc " * 3), (6, "x " * 50 + notice), (7, "cc by " * 3000 + "licensed under cc-by-nc 4.0"),
        (8, "this work is licensed " + "this work is " * 9 + "under the general license version"),
    ]
    got = {r["doc_id"]: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    labels = {i: r["labels"] for i, r in got.items()}
    assert labels == {1: "cc-by", 2: "cc-by", 3: "cc-by,cc-by-sa", 4: "", 5: "cc-by", 6: "gpl,gpl-notice", 7: "cc-by,cc-by-nc", 8: ""}
    assert got[6]["score"] == 1.0 and got[4]["score"] < 0.5


def longest(votes):
    """The longest row of votes in which place and position both grow, by looking at every earlier vote."""
    best = []
    for k, (place, at) in enumerate(votes):
        best.append(1 + max([best[j] for j in range(k) if votes[j][0] < place and votes[j][1] < at], default=0))
    return max(best, default=0)


def by_hand(text):
    """(labels, score) of a text, from its words and the templates alone."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    labels, score = set(), 0.0
    for label, base, phrase in license.TEMPLATES:
        own = phrase.split()
        pairs = len(own) - 1
        votes = [(p, at) for p in range(len(words) - 1) for at in range(pairs) if words[p : p + 2] == own[at : at + 2]]
        lines = sorted({p - at for p, at in votes})
        if base:
            bands = [{x} for x in lines]
        else:
            breaks = [0, *(sum(b - a > license.GAP for a, b in zip(lines[:k], lines[1 : k + 1])) for k in range(1, len(lines)))]
            bands = [{x for _, x in g} for _, g in groupby(zip(breaks, lines), key=lambda z: z[0])]
        for band in bands:
            mine = [v for v in votes if v[0] - v[1] in band]
            count = len(mine)
            if not base:
                reach = license.span(pairs)
                count = max(longest([v for v in mine if p <= v[0] < p + reach]) for p, _ in mine)
            share = min(1.0, count / pairs)
            score = max(score, share)
            if share == 1 if base else share >= license.SHARE:
                labels.add(label)
    return ",".join(sorted(labels)), score


def made_up(rng):
    """Pieces of templates, whole, cut, repeated, and with words put in."""
    out = []
    for _ in range(rng.randint(0, 5)):
        own = rng.choice(license.TEMPLATES)[2].split()
        kind = rng.randint(0, 3)
        if kind == 1:
            own = own[rng.randint(0, 3) :][: rng.randint(1, 9)] * rng.randint(1, 4)
        elif kind == 2:
            for _ in range(rng.randint(1, 3)):
                own.insert(rng.randint(0, len(own)), rng.choice(own + ["also", "x"]))
        elif kind == 3:
            own = [w for w in own if rng.random() < 0.93]
        out += own
    return " ".join(out)


def test_labels_and_score_by_hand_and_in_sql(spark):
    rng = random.Random(8)
    texts = [None, "", "cc by " * 5, "Licensed under CC BY, CC-BY 4.0", "cc by nc " * 3, "4.0 SA by cc under licensed"]
    texts += ["cc by " * 300 + "licensed under cc-by-nc 4.0", "this work is licensed " + "this work is " * 9 + "under the general license version"]
    texts += [made_up(rng) for _ in range(300)]
    texts += texts[-3:]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    with duckdb.connect() as db:
        db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
        ran = db.execute(license.SQL)
        columns = [c[0] for c in ran.description]
        sql = {r[0]: dict(zip(columns, r)) for r in ran.fetchall()}
    assert set(got) == set(sql) == set(range(len(texts)))
    for doc_id, text in rows:
        assert got[doc_id].asDict() == sql[doc_id], text
        assert (got[doc_id]["labels"], got[doc_id]["score"]) == by_hand(text), text
    assert len({r["labels"] for r in got.values()}) > 20


def test_odd_rows_and_no_rows(odd, empty):
    assert len(license.scan(odd).collect()) == 5
    assert license.scan(empty).collect() == []
