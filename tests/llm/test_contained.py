"""Items of 1 to 4 words: the operator and its SQL, each against brute force."""

import re

import duckdb

from skein.llm.decontaminate import find_contained
from skein.llm.queries import CONTAINED

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def _words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def _grams(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_short_items(spark):
    docs = [(1, "One two three four five six seven eight"), (2, "two  THREE\tfour"), (3, "one"), (4, None), (5, ""), (6, "two three and four five one two"), (7, "three four five six seven eight nine ten")]
    items = [(1, "two three four"), (2, "ONE"), (3, "four five"), (4, ""), (5, None), (6, "one two three four five six seven eight"), (7, "six seven eight nine")]
    want = set()
    for i, t in docs:
        for k, x in items:
            w = _words(x)
            n = min(len(w), 5)
            if n and 100 * len(_grams(w, n) & _grams(_words(t), n)) >= 80 * len(_grams(w, n)):
                want.add((i, k))
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"create table {name} ({key} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", rows)
    told = {r[:2] for r in con.execute(CONTAINED).fetchall()}
    got = {(r.doc_id, r.item_id) for r in find_contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 6 and got == want and told == want
