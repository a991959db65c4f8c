"""Personal data: patterns with checks, and terms that give protected values away."""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

KINDS = ("email", "ip", "card", "phone")
#: Distinct lines in which a term must stand beside a value.
SUPPORT = 5
#: Share of a value's information that a term must give away.
THRESHOLD = 0.8
#: Candidate terms up to this number are looked up in a set; more are joined.
IN_MEMORY = 100_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    out, floor = [], 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > floor and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            out.append((a, m.end()))
            floor = m.end()
    return out


def _ip_ok(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _card_ok(s: str) -> bool:
    d = _NO_DIGIT.sub("", s)
    return 16 <= len(d) <= 19 and _luhn(d)


def _phone_ok(s: str) -> bool:
    return 8 <= len(_NO_DIGIT.sub("", s)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind, then start, in code points: leftmost, not overlapping within a kind; failing matches are dropped."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for kind, pattern, ok in (("ip", _IP, _ip_ok), ("card", _CARD, _card_ok), ("phone", _PHONE, _phone_ok)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if ok(m.group())]
    return out


_LINES = "line long, entities array<long>, terms array<string>, n_lines long"
_FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, redacted string"


def _hash(s: str) -> int:
    import xxhash

    return int.from_bytes(xxhash.xxh64_digest(s.encode()), "big", signed=True)


def lines_with_values(text: str):
    """For each line that holds protected values: a hash of the line, the distinct values and the distinct terms outside of them."""
    lines: dict[int, list[tuple[str, int, int]]] = {}
    for kind, a, b in base_spans(text):
        lines.setdefault(text.rfind("\n", 0, a) + 1, []).append((kind, a, b))
    for start, own in lines.items():
        end = text.find("\n", start)
        line = text[start : end if end >= 0 else len(text)]
        entities = {_hash(f"{k}:{text[a:b].lower()}") for k, a, b in own}
        free = {t for t, _, _ in _places(line, None, [(k, a - start, b - start) for k, a, b in own])}
        yield _hash(line), sorted(entities), sorted(free)


def _terms(text: str) -> set[str]:
    return {t.lower() for t in set(_TERM.findall(text))}


def _places(text: str, wanted: frozenset[str] | None = None, spans: list[tuple[str, int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Each occurrence of the terms (None: of all terms) that overlaps no base span: term, start, end."""
    starts, ends = [], []
    for a, b in sorted(s[1:] for s in (base_spans(text) if spans is None else spans)):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for m in _TERM.finditer(text):
        t, (a, b) = m.group().lower(), m.span()
        if wanted is None or t in wanted:
            i = bisect_left(starts, b) - 1
            if i < 0 or ends[i] <= a:
                out.append((t, a, b))
    return out


def _values(batches):
    """Lines with values, one row each; and for each text a row with its number of lines alone."""
    for b in batches:
        rows, total = [], 0
        for text in b.column("text"):
            text = text.as_py()
            total += text.count("\n") + 1
            rows += lines_with_values(text)
        rows.append((None, None, None))
        n = [0] * (len(rows) - 1) + [total]
        yield pa.record_batch({
            "line": pa.array([r[0] for r in rows], pa.int64()),
            "entities": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
            "terms": pa.array([r[2] for r in rows], pa.list_(pa.string())),
            "n_lines": pa.array(n, pa.int64()),
        })


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def term_lines(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: in how many lines of the corpus each of the terms stands."""
    n = terms.count()
    if n <= IN_MEMORY:
        wanted = frozenset(r[0] for r in terms.collect())

        def count(batches):
            total: dict[str, int] = {}
            for b in batches:
                for text in b.column("text"):
                    for line in text.as_py().split("\n"):
                        for t in wanted.intersection(_terms(line)):
                            total[t] = total.get(t, 0) + 1
            yield pa.record_batch({"term": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        return docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))

    def each(batches):
        for b in batches:
            for text in b.column("text"):
                words = [t for line in text.as_py().split("\n") for t in _terms(line)]
                yield pa.record_batch({"term": pa.array(words, pa.string())})

    return docs.select("text").mapInArrow(each, "term string").join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """row, terms: where any of the terms stands outside base spans, sorted; rows without one are left out."""

    def each(batches):
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text")):
                found = _places(text.as_py())
                yield pa.record_batch({"row": pa.array([row] * len(found), pa.int64()), **{k: pa.array([f[i] for f in found], t) for i, (k, t) in enumerate((("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())))}})

    every = docs.select("row", "text").mapInArrow(each, "row long, term string, start int, end int").join(terms, "term", "left_semi")
    return every.select("row", "start", "end").distinct().groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("terms"))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its values generalised to their kind in brackets, and terms removed."""
    end, kept = 0, []
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= end:
            kept += [text[end:a], "" if kind == "term" else f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*kept, text[end:]])


def _find(wanted: frozenset[str] | None):
    """Counts, spans and the redacted text of each row; terms are looked up in ``wanted``, or None: stand in the column ``terms``."""

    def run(batches):
        for b in batches:
            cols: dict[str, list] = {k: [] for k in (*KINDS, "base", "spans", "redacted")}
            told = None if wanted is not None else b.column("terms").to_pylist()
            for i, text in enumerate(b.column("text")):
                text = text.as_py()
                spans = base_spans(text)
                if wanted is None:
                    more = [("term", x["start"], x["end"]) for x in told[i] or ()]
                else:
                    more = [] if not wanted or wanted.isdisjoint(_terms(text)) else [("term", x, y) for _, x, y in _places(text, wanted, spans)]
                for k in KINDS:
                    cols[k].append(sum(s[0] == k for s in spans))
                cols["base"].append(joined(spans))
                cols["spans"].append(joined(spans + more))
                cols["redacted"].append(redacted(text, spans + more))
            yield pa.record_batch(
                [b.column("doc_id"), *(pa.array(cols[k], pa.int64()) for k in KINDS), *(pa.array(cols[k], pa.string()) for k in ("base", "spans", "redacted"))],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", "redacted"],
            )

    return run


def telling_terms(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """term: the terms that give a protected value away (see ``find_private``)."""
    scratch = common.Scratch(docs.sparkSession, "private")
    held = scratch.save(docs.select("text").mapInArrow(_values, _LINES))
    lines = held.where("line is not null").select("line", "terms", F.explode("entities").alias("entity"))
    # A value in fewer distinct lines has no term that stands beside it in enough: the pairs are counted for the others only.
    entities = lines.groupBy("entity").agg(F.countDistinct("line").alias("lines"), F.count("*").alias("n_entity")).where(F.col("lines") >= support)
    entities = scratch.save(entities.drop("lines"))
    pairs = lines.join(entities, "entity").select("entity", "line", "n_entity", F.explode("terms").alias("term"))
    often = pairs.groupBy("entity", "term").agg(F.countDistinct("line").alias("lines"), F.count("*").alias("both"), F.max("n_entity").alias("n_entity"))
    often = scratch.save(often.where(F.col("lines") >= support))
    total = held.agg(F.sum("n_lines")).first()[0] or 0
    told = often.join(term_lines(docs, often.select("term").distinct()).withColumnRenamed("n", "n_term"), "term")
    pmi = F.log(F.col("both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    own = F.log(F.lit(float(total)) / F.col("n_entity"))
    out = scratch.save(told.where(pmi >= threshold * own).select("term").distinct())
    scratch.drop(held, entities, often)
    return out


def find_private(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """Spans of personal data: doc_id, n_email, n_ip, n_card, n_phone, base, spans (strings kind:start:end, comma-joined), redacted.

    Base spans come from patterns.  A term is added (kind ``term``) wherever it stands in the corpus outside base
    spans, beside the value or not, if it gives a value away: with probabilities counted over all lines, repeated ones each, its
    pointwise mutual information with the value reaches ``threshold`` times the information of the value itself, in ``support``
    distinct lines or more, so that copies of one line are no evidence.  In ``redacted`` values are generalised to their kind, and terms removed.

    Null and empty texts have no spans.  Very long texts and lines are searched whole.  A repeated row is searched like any other; a null
    doc_id stays null.  Of overlapping spans the earlier, or the longer, names what stands for both.  Other columns are not read.  An empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    docs = common.texts(docs)
    told = telling_terms(docs, support, threshold)
    if told.count() <= IN_MEMORY:
        shared = spark.sparkContext.broadcast(frozenset(r[0] for r in told.collect()))
        return docs.mapInArrow(lambda batches: _find(shared.value)(batches), _FOUND)
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    return docs.join(term_spans(docs, told), "row", "left").select("doc_id", "text", "terms").mapInArrow(_find(None), _FOUND)
