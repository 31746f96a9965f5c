"""Quality rules, ranked search and conversation repair against plain Python on small tables."""
import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterflow.llm import conversations, quality, search
from tests.llm.data import empty, odd, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Quality rules

def counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = list(zip(w, w[1:], w[2:]))
    often = Counter(grams)
    again = {p for i, g in enumerate(grams) if often[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(again))


def judged_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, m int, row string, kept int, fences int")


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(900):
        lang, source = ("en", "de", None)[i % 3], ("hot", "hot", f"s{i % 7}", None)[i % 4]
        rows.append((i, prose(rng, rng.randint(55, 160)).replace(" ", " \n", 1), lang, source))
    rows[7] = (7, rows[7][1].replace(" ", "### "), *rows[7][2:])
    rows[8] = (8, "\n".join([prose(rng, 60)] * 2) + "\n" + prose(rng, 200), *rows[8][2:])
    rows[10] = (10, " ".join(prose(rng, 1) * 4 for _ in range(80)), *rows[10][2:])
    rows[11] = (11, "short text", *rows[11][2:])
    rows += [(i, t, "xx", "rare") for i, t, *_ in odd_rows()] + [rows[20]] * 3
    return [(*r, 1, "r", 2, 3) for r in rows]


def fence(values, low, floor):
    bucket = lambda v: v if v < 128 else v >> (v.bit_length() - 7) << (v.bit_length() - 7)
    ordered = sorted(values)
    q1, q3 = (bucket(ordered[-(-len(ordered) * k // 4) - 1]) for k in (1, 3))
    spread = max(q3 - q1, floor)
    return (q1 - 3 * spread if low else -10 ** 9), q3 + 3 * spread


def expected(rows):
    measured = []
    for r in rows:
        n, chars, symbols, lines, dup, again = c = counts(r[1])
        v = (chars * 100 // n if n else None, symbols * 1000 // n if n else None, dup * 1000 // lines if lines else None, again * 1000 // n if n else None)
        measured.append((r, c, v, n < 50 or 100 * again > 50 * n))
    out = []
    for r, c, v, failed in measured:
        kept = not failed
        for k, m in enumerate(quality.MEASURES):
            groups = [[x[2][k] for x in measured if not x[3] and same(x[0])] for same in
                      (lambda x: (x[2], x[3]) == (r[2], r[3]), lambda x: x[2] == r[2], lambda x: True)]
            group = next((g for g in groups[:2] if len(g) >= quality.MIN_ROWS), groups[2])
            if kept:
                low, high = fence(group, m.low, m.floor)
                kept = low <= v[k] <= high
        out.append((r[0], *c, failed, kept))
    return Counter(out)


def test_quality_counts_and_verdicts_match_python(spark):
    rows = corpus()
    got = quality.judge(judged_rows(spark, rows), carry=["doc_id"]).select("row.doc_id", "m.*", "base_failed", "kept").collect()
    want = expected(rows)
    assert Counter(map(tuple, got)) == want
    verdict = {r["doc_id"]: r["kept"] for r in got}
    assert not any(verdict[i] for i in (7, 10, 11)) and sum(verdict.values()) > 800


def test_quality_keeps_rows_whole(spark):
    rows = corpus()
    docs = judged_rows(spark, rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    want = expected(rows)
    assert kept.count() == sum(n for r, n in want.items() if r[-1])
    assert kept.where("m = 1 and kept = 2").count() == kept.count()


def test_quality_of_nothing(spark):
    none = judged_rows(spark, [])
    assert quality.judge(none).count() == 0 and quality.keep_good(none).columns == none.columns
    short = judged_rows(spark, [(1, None, None, None, 1, "r", 2, 3), (2, "", "en", "a", 1, "r", 2, 3)])
    assert [(r["base_failed"], r["kept"]) for r in quality.judge(short).collect()] == [(True, False)] * 2


def test_sketches_merge_and_bound_the_quartiles(spark):
    rng = random.Random(8)
    values = [int(rng.lognormvariate(9, 2)) for _ in range(5000)]
    table = spark.createDataFrame([(i % 5, v) for i, v in enumerate(values)], "g int, v long")
    parts = table.groupBy("g", F.lit(0).alias("measure"), quality._bucket("v").alias("bucket")).agg(F.count("*").alias("n"))
    whole = quality.quartiles(quality.merged(parts, []), []).first()
    ordered = sorted(values)
    for name, share in (("q1", 0.25), ("q3", 0.75)):
        exact = ordered[math.ceil(len(values) * share) - 1]
        assert exact * 63 / 64 - 1 <= whole[name] <= exact


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranking(docs, items, k):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(c.values()) for _, c in tf]
    some, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in tf for t in c)
    found = []
    for item, text in set(items):
        query = Counter(t for t in terms(text) if t in df)
        weight = {t: math.floor(1000 * math.log((2 * some + 2) / (2 * df[t] + 1))) for t in query}
        scores = []
        for (doc, c), length in zip(tf, n):
            m = 25 + (75 * length * some) // total if total else 0
            score = sum(q * weight[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in query.items() if t in c)
            if score > 0:
                scores.append((-score, doc is not None, doc or 0, doc))
        found += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return Counter(found)


@pytest.fixture
def searched():
    rng = random.Random(4)
    docs = [(r[0], r[1]) for r in odd_rows()] + [(100 + i, prose(rng, rng.randint(1, 80))) for i in range(300)]
    docs += [(500 + i, "the same Words, again and again: ka-ra!") for i in range(40)] + [(None, "kara lora")] * 2
    items = [(i, prose(rng, rng.randint(1, 12))) for i in range(30)]
    items += [(3, items[3][1]), (3, "KARA"), (None, "kara Lora ünïcode"), (40, None), (41, "... !"), (42, "nowhere to be found"), (43, "again words"), (44, prose(rng, 3000))]
    return docs, items


@pytest.mark.parametrize("limit", [200_000, 20])
def test_search_matches_plain_ranking(spark, searched, monkeypatch, limit):
    docs, items = searched
    monkeypatch.setattr(search, "TERMS_PER_BATCH", limit)
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, terms string").repartition(5)
    got = search.search(search.build_index(table), spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int"), 7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == ranking(docs, items, 7)


def test_search_of_nothing(spark):
    none = empty(spark).withColumn("item_id", F.lit(1).cast("long"))
    index = search.build_index(none)
    some = spark.createDataFrame([(1, "kara")], "item_id long, text string")
    assert search.search(index, some).count() == 0 and search.search(search.build_index(odd(spark)), none).count() == 0
    blank = search.build_index(spark.createDataFrame([(1, None), (2, " .")], "doc_id long, text string"))
    assert blank.count() == 2 and search.search(blank, some).count() == 0


def test_few_documents_are_scored_and_bounds_hold(searched):
    import numpy as np
    import pyarrow as pa

    docs = [(i, t) for i, t in searched[0] if t]
    encoded = [t.encode() for _, t in docs]
    count, first, hashes, tf = search._postings(encoded)
    pack = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array(count, pa.int64()), pack(hashes), pack(tf)], ["doc_id", "n", "terms", "tf"])
    block = search.Block(batch)
    impacts = block.impacts(len(docs), int(count.sum()))
    sketches = block.sketches(impacts)
    for number in range(search.HASHES):
        assert (sketches[number][search.coordinates(block.terms, number), block.doc].astype(np.int64) * search.STEP >= impacts).all()
    rows = [{"query": 0, "terms": hashes[first[20]:first[21]].tobytes(), "tf": tf[first[20]:first[21]].tobytes()}]
    queries = search.Batch(rows)
    queries.weigh({}, len(docs))
    best = [search.Best(3)]
    assert 3 <= search._search_block(block, queries, best, len(docs), int(count.sum())) < len(docs) / 2


# Conversation repair

def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        part = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        role, text = part(role), part(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """Least cost, then least audit, over all edits, by search in that order (an audit is compared letter by letter)."""
    accepted = re.compile(r"(s?(ua)+)?")
    heap, done = [(0, "", 0, "", ())], set()
    ends = []
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if ends and cost > ends[0][0]:
            break
        if (at, roles[-2:], cost, audit) in done:
            continue
        done.add((at, roles[-2:], cost, audit))
        if at == len(rows) and accepted.fullmatch(roles):
            ends.append((cost, audit, lines))
            ends.sort()

        def go(price, letter, step, role=None, line=None):
            new = roles + (role or "")
            if re.fullmatch(r"s?(ua)*u?", new):
                heapq.heappush(heap, (cost + price, audit + letter, at + step, new, lines + ((line,) if line is not None else ())))

        if len(audit) < len(rows) + 8:
            for role in ("user", "assistant"):
                go(3, "I", 0, role[0], f"{role}:")
        if at < len(rows):
            role, text, forced, cut = rows[at]
            go(4, "D", 1)
            if not forced:
                if role[:1] in ("s", "u", "a"):
                    go(3 * cut, "K", 1, role[0], f"{role}:{text}")
                for new in ("user", "assistant"):
                    go(3 + 3 * cut, "R", 1, new[0], f"{new}:{text}")
    return ends[0]


def repaired(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked, n = set(), [], Counter()
    for _, role, text, *_ in [(r[0], r[1], r[2]) for r in rows]:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        n[kind] += 1
        marked.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, audit, lines = cheapest(marked)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def talks(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        length = rng.choice([1, 2, 3, 4, 5, 6, 7])
        for turn in range(length):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why", "So be it.\n", " \t", "", None, "é?", prose(rng, 5) + ".", prose(rng, 5)])
            rows.append((conv, None if rng.random() < 0.05 else turn + (rng.random() < 0.1), role, text))
        if rng.random() < 0.2:
            rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_matches_search_over_all_edits(spark, seed):
    rows = talks(seed, 60)
    table = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "conv_id long, turn long, role string, text string, cost int, h string, there boolean")
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(conversations.damage(table), "there").collect()}
    left = {c: [] for c, *_ in rows}
    for c, *rest in damaged(rows):
        left[c].append(tuple(rest))
    assert got == {c: repaired(found) for c, found in left.items()}
    plain = {r[0]: tuple(r)[1:] for r in conversations.repair(table).collect()}
    assert plain == {c: repaired([(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in rows if k == c]) for c in left}


def test_repair_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversations.repair(spark.createDataFrame([], schema)).count() == 0
    gone = spark.createDataFrame([(7, 1, "user", "a.", False)], schema + ", there boolean")
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversations.repair(gone, "there").collect()] == [(7, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_giant_conversation_is_streamed_and_spilled(spark):
    rows = [(1, i, ("user", "assistant", "tool")[i % 3], "same." if i % 3 == 0 else f"turn {i}" + "." * (i % 2)) for i in range(6000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        got = conversations.repair(table).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    for limit in (64, 1 << 20):
        held = conversations.Conversation(limit)
        seen = set()
        for _, turn, role, text in rows:
            held.row(turn, role, text, False, (role, text) in seen, text[-1] not in ".!?")
            seen.add((role, text))
        found.append((1, *held.end()))
    assert found[0] == found[1] == tuple(got[0]) and len(got) == 1 and len(found[0][7]) >= 6000
