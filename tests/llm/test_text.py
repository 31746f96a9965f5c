"""Operators over documents, held against plain versions of what they should give."""
import collections
import ctypes
import gc
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterflow.llm import decontamination, jaccard, katz, licenses, packing, pii, shards, substrings, toxicity
from meterflow.llm.catalog import ORACLE, QUERIES
from tests.llm.data import empty, odd, odd_rows, prose
from tests.oracle import compare, duck

SMALL = "/root/testdata/sf0.001"
TOKENS = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def corpus():
    """Families of near copies, copies, shared passages and short texts, some without ids."""
    rng = random.Random(3)
    passages = [prose(rng, 45) for _ in range(4)]
    texts = []
    for family in range(6):
        words = prose(rng, rng.choice([30, 80, 200])).split()
        for _ in range(rng.choice([1, 3, 25])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(9)}"
            texts.append(" ".join(own) + (" " + rng.choice(passages) if rng.random() < 0.3 else ""))
    texts += [rng.choice(passages) + " " + prose(rng, 40) for _ in range(25)]
    texts += ["", None, "one", "One", "two words", "Two Words", "a b c d", passages[0], passages[0].upper()]
    rng.shuffle(texts)
    return list(enumerate(texts, 1))


@pytest.fixture(scope="module")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(3).cache()


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(QUERIES)))
def test_sql_says_the_same(spark, name):
    assert compare(spark, duck(SMALL), name, QUERIES[name], ORACLE[name], SMALL) in ([], ["no rows"])


# toxicity

def test_toxic_documents_are_found_in_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.op1_toxicity(spark, folder).join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    found = collections.Counter((r["toxic"], r["predicted"]) for r in rows)
    assert found[1, 1] >= 0.9 * (found[1, 0] + found[1, 1])
    assert found[0, 1] <= 0.01 * (found[0, 0] + found[0, 1])
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_fold_is_the_crc_of_the_id(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id"), toxicity.held_out().alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in ids)


def test_a_score_depends_on_the_text_alone(spark):
    model = toxicity.Model(np.arange(0, 1 << toxicity.BITS, 3), np.linspace(-2, 2, (1 << toxicity.BITS) // 3 + 1), 0.1)
    rng = random.Random(1)
    texts = ["same text of some words", "", None, *[prose(rng, 50) for _ in range(20)], "same text of some words"]
    for parts in (1, 5):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts, "doc_id")
        by_id = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
        assert by_id[0] == by_id[len(texts) - 1]
        assert by_id[1] == by_id[2]


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)], [(1, None), (None, 1)], [(900, 0), (901, 1)]])
def test_labels_of_one_class_or_none(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(odd(spark), table)
    assert toxicity.score(odd(spark), model).count() == len(odd_rows())
    kept = toxicity.keep_below(odd(spark), model)
    assert kept.columns == odd(spark).columns


# surrogates

def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in pii.replace_entities(df, key).orderBy("doc_id").collect()]


def test_surrogates_keep_type_and_format(spark):
    mail, phone, address, card, secret = replaced(spark, ["to Jo.Doe7@mail3.example.com!", "call +1 (377) 555-0271 now", "at 10.200.3.45, yes",
                                                          "pays 4111 1111 1111 1111", 'token = "87e15d78b9d8ef29b6c10061e3551a60fa07e990"'])
    assert re.fullmatch(r"to [a-z]{2}\.[a-z]{3}\d@[a-z]{4}\d\.[a-z]{7}\.com!", mail) and "doe" not in mail.lower()
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", phone) and "555-0271" not in phone
    octets = re.fullmatch(r"at (\d\d)\.(\d{3})\.(\d)\.(\d\d), yes", address)
    assert octets and all(int(x) < 256 for x in octets.groups())
    digits = [int(x) for x in re.sub(r"\D", "", card)]
    doubled = [x if i % 2 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits)]
    assert re.fullmatch(r"pays 4\d{3} \d{4} \d{4} \d{4}", card) and sum(doubled) % 10 == 0 and "1111 1111" not in card
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', secret) and "87e15d78" not in secret


def test_names_keep_gender_and_script(spark):
    one, two, three, four = replaced(spark, ["Herr Paul Klee", "Mr. Paul Klee", "Frau Ida Klee", "господин Иван Петров"])
    male, female = (pii.NAMES[g, "latin"].split() for g in ("male", "female"))
    assert one.split()[1] in male and three.split()[1] in female and four.split()[1] in pii.NAMES["male", "cyrillic"].split()
    assert one.split()[1:] == two.split()[1:] and two.startswith("Mr. ")
    assert re.fullmatch("[А-Яа-яё]+", four.split()[2])


def test_one_surrogate_for_an_entity_and_none_for_two(spark):
    rng = random.Random(2)
    mentions = [f"{rng.randrange(10)}.{rng.randrange(10)}.{rng.randrange(3)}.{rng.randrange(3)}" for _ in range(400)]
    new = replaced(spark, mentions)
    pairs = set(zip(mentions, new))
    assert len(pairs) == len(set(mentions)) == len(set(new))
    assert not set(new) & set(mentions)
    assert replaced(spark, mentions[:50]) != replaced(spark, mentions[:50], "other key")
    a, b = replaced(spark, ["A.B@x.org and a.b@X.org", "+1 (377) 555-0271 is 1-377-555-0271"])
    assert a.split()[0] == a.split()[2].lower() or a.split()[0].lower() == a.split()[2].lower()
    assert re.sub(r"\D", "", b.split(" is ")[0]) == re.sub(r"\D", "", b.split(" is ")[1])


def test_names_are_found_again_without_their_title(spark):
    key = "ghp_" + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"
    one, two, three, four = replaced(spark, ["Mr. John Smith came. John Smith sat, Smith said; Mr. Smith left Smithfield. Mrs. Smith stayed", "token " + key, "Smith was here",
                                             "Smith first, then Mr. John Smith and Mr. Paul Smith"])
    found = re.fullmatch(r"Mr\. (\w+) (\w{5}) came\. (\w+) (\w{5}) sat, (\w{5}) said; Mr\. (\w{5}) left Smithfield\. Mrs\. (\w{5}) stayed", one)
    given, family, *rest, other = found.groups()
    assert rest == [given, family, family, family] and family != "Smith" and other not in ("Smith", family)
    assert re.fullmatch(r"token ghp_\w{36}", two) and key not in two
    assert three == "Smith was here"
    assert "Smith" not in four and four.startswith(family) and f"Mr. {given} {family}" in four


def test_full_formats_get_wider(spark, monkeypatch):
    monkeypatch.setattr(pii, "MAX_ROUNDS", 2)
    letters = pii.ALPHABETS["latin"]
    mentions = [".".join(f"{n:04}") for n in range(6_000)] + [f"Mr. {a.upper()}{b}" for a in letters for b in letters]
    new = replaced(spark, mentions)
    assert len(set(new)) == len(mentions) and not set(new) & set(mentions)
    assert all(re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}" if "Mr" not in old else r"Mr\. [A-Z][a-z]+", text) for old, text in zip(mentions, new))


def test_texts_without_entities_stay(spark):
    texts = [None, "", "nothing here", "room 12 of 2024", "a@b", "1.2.3", "x" * 100_000]
    assert replaced(spark, texts) == texts
    out = pii.replace_entities(odd(spark), "k", with_count=True)
    assert out.columns == [*odd(spark).columns, "n_entities"]
    assert collections.Counter(r["text"] for r in out.collect()) == collections.Counter(r[1] for r in odd_rows())


# licenses

def test_places_of_base_phrases(spark):
    texts = ["Under the MIT License. under-the/mit license", "CC BY-NC cc by nc cc by", "apache license, version 2.0", "under the mit", None, "İ under the mit license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    assert [rows[i]["n_base"] for i in range(6)] == [2, 2, 1, 0, 0, 1]
    assert (rows[0]["first_word"], rows[0]["last_word"], rows[0]["base_labels"]) == (0, 4, "mit")
    assert (rows[1]["first_word"], rows[1]["last_word"], rows[1]["n_words"]) == (0, 3, 8)
    assert rows[3]["first_word"] is None and rows[4]["n_words"] == 0 and rows[4]["labels"] == ""


def test_notices_with_words_put_in_or_left_out(spark):
    notice = dict((label, text) for label, text in licenses.NOTICES)["isc"].split()
    put_in = notice[:8] + ["really"] + notice[8:]
    left_out = notice[:5] + notice[6:]
    far = notice[:6] + ["x"] * 30 + notice[6:9]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate([notice, put_in, left_out, far])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    assert rows[0]["score"] == 1 and [rows[i]["labels"] for i in range(4)] == ["isc", "isc", "isc", ""]
    assert all(rows[i]["base_labels"] == "" for i in range(4))


# Jaccard join

def sets_of(rows):
    result = {}
    for i, text in rows:
        w = split(ascii_lower(text))
        result[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return result


def linked(rows):
    sets = sets_of(rows)
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, groups_of(ids, links)


@pytest.mark.parametrize("block, common", [(jaccard.BLOCK, jaccard.COMMON), (7, 5)])
def test_groups_of_near_copies(spark, corpus, documents, monkeypatch, block, common):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "COMMON", common)
    sets, group = linked(corpus)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(documents).collect()}
    assert got == {i: (len(sets[i]), group[i]) for i in sets}
    assert len(set(group.values())) < len(group)


def test_documents_are_told_apart_by_id_and_text(spark):
    """Two texts under one id, copies without an id and a repeated row: every text is linked for itself."""
    rng = random.Random(11)
    one, two, three = (prose(rng, 40) for _ in range(3))
    rows = [(1, one), (5, two), (5, three), (7, two), (None, three), (None, three), (None, one), (9, three + " more"), (3, None), (None, ""), (None, "alone in the world of words"), (1, one)]
    got = Counter(map(tuple, jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == Counter([(1, 36, 1), (5, 36, 5), (5, 36, 5), (7, 36, 5), (None, 36, 5), (None, 36, 1), (9, 37, 5), (3, 0, 3), (None, 0, None), (None, 2, None)])


def test_links_come_from_the_trees(spark, corpus, documents, monkeypatch):
    want = sum(i != g for i, g in linked(corpus)[1].items())
    monkeypatch.setattr(jaccard, "_tree_pairs", lambda grouped, best=False: grouped.select(F.col("class").alias("a"), F.col("class").alias("b")).where("false"))
    assert want and jaccard.link_documents(documents).where("doc_id <> component_id").count() < want / 2


def test_partners_are_few_and_tie_near_copies():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    sets = []
    for _ in range(500):
        own = base.copy()
        at = rng.random(len(own)) < 0.05
        own[at] = rng.integers(0, 1 << 63, at.sum()).astype(np.uint64)
        sets.append(np.unique(own))
    sets.sort(key=len)
    bits = np.frombuffer(b"".join(jaccard.bitmap(s, jaccard.TREE_BITS) for s in sets), np.uint64).reshape(len(sets), -1)
    a, b = jaccard.Tree(np.array([len(s) for s in sets]), np.arange(len(sets)), bits).partners()
    assert len(a) <= 2 * len(sets) and (a != b).all()
    true = [(x, y) for x, y in zip(a.tolist(), b.tolist()) if 7 * len(np.intersect1d(sets[x], sets[y])) >= 3 * (len(sets[x]) + len(sets[y]))]
    assert len(set(groups_of(list(range(len(sets))), true).values())) < 0.1 * len(sets)


def test_the_tree_loses_no_pair():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 63, rng.integers(5, 300)).astype(np.uint64)
        for _ in range(rng.integers(1, 9)):
            own = base.copy()
            at = rng.random(len(own)) < 0.1
            own[at] = rng.integers(0, 1 << 63, at.sum()).astype(np.uint64)
            sets.append(np.unique(own))
    sets.sort(key=len)
    bits = np.frombuffer(b"".join(jaccard.bitmap(s, jaccard.TREE_BITS) for s in sets), np.uint64).reshape(len(sets), -1)
    n = np.array([len(s) for s in sets])
    component = np.arange(len(sets)) // 5
    tree = jaccard.Tree(n, component, bits)
    got = set(zip(*(x.tolist() for x in tree.pairs())))
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if component[a] != component[b]
            and 7 * len(np.intersect1d(sets[a], sets[b])) >= 3 * (n[a] + n[b])}
    assert want and want <= got and len(got) < 0.5 * len(sets) ** 2 / 2
    assert len(tree.levels) > 1


def near_copies(rng, n):
    """Sizes and signatures of sets made from one: whatever pair is asked, its bits do not rule out a link."""
    base = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    sets = sorted((base[rng.random(len(base)) >= 0.1] for _ in range(n)), key=len)
    bits = np.frombuffer(b"".join(jaccard.bitmap(s, jaccard.TREE_BITS) for s in sets), np.uint64).reshape(n, -1)
    return np.array([len(s) for s in sets]), bits


def most_held(call):
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_tree_of_near_copies_needs_little_memory():
    """All pairs of a large group are gone through, but a bounded number at a time; they were all side by side, with both signatures."""
    n, bits = near_copies(np.random.default_rng(8), 3000)
    tree = jaccard.Tree(n, np.arange(len(n)), bits)
    count, held = most_held(lambda: sum(len(a) for a, _ in tree.some_pairs()))
    assert count > 0.9 * len(n) * (len(n) - 1) / 2 and held < 40
    assert most_held(tree.partners)[1] < 40


@pytest.mark.parametrize("at_once", [1, 700, 100_000])
def test_pieces_of_a_tree_give_the_same_pairs(monkeypatch, at_once):
    n, bits = near_copies(np.random.default_rng(9), 150)
    component = np.arange(len(n)) // 3
    tree = jaccard.Tree(n, component, bits)
    monkeypatch.setattr(jaccard, "SIGNATURES_AT_ONCE", 13)
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", at_once)
    a, b = (x.ravel() for x in np.indices((len(n), len(n))))
    a, b = a[a < b], b[a < b]
    kept = tree.may_link(0, a, b)
    pairs = list(zip(*(x.tolist() for x in tree.pairs())))
    assert sorted(pairs) == sorted(zip(a[kept].tolist(), b[kept].tolist())) and len(pairs) == len(set(pairs))
    best = sorted(zip(*(x.tolist() for x in tree.partners())))
    monkeypatch.undo()
    assert best == sorted(zip(*(x.tolist() for x in tree.partners())))


def test_near_duplicates_read_few_texts_at_a_time(spark, monkeypatch):
    """Batches end by the bytes of their texts, and the session's setting is as before."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(key), []
    monkeypatch.setattr(jaccard, "_documents", lambda docs, own=jaccard._documents: seen.append(spark.conf.get(key)) or own(docs))
    jaccard.link_documents(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"))
    assert seen == [str(4 << 20)] and spark.conf.get(key) == before


# repeated runs

def without_repeats(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = split(text)
        drop = set()
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            if s in seen:
                drop.update(range(k, k + window))
            seen.add(s)
        kept = [x for k, x in enumerate(w) if k not in drop]
        out[i] = (len(w), len(drop), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def test_repeated_runs_go(spark, corpus, documents):
    rows = {r["doc_id"]: tuple(r)[1:4] for r in substrings.remove_repeats(documents).collect()}
    assert rows == without_repeats(corpus, 20)
    assert sum(r[1] for r in rows.values())
    kept = substrings.remove_repeats(documents, with_text=True).collect()
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in kept)


def test_runs_within_one_document_and_other_windows(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(60))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: tuple(r)[1:4] for r in substrings.remove_repeats(df).collect()} == without_repeats(rows, 20)
    seven = substrings.remove_repeats(df, window=9, period=7, cover=(0, 1, 3))
    assert {r["doc_id"]: tuple(r)[1:4] for r in seven.collect()} == without_repeats(rows, 9)
    with pytest.raises(ValueError):
        substrings.remove_repeats(df, period=13, cover=(0, 1, 3))


def test_a_repeated_row_is_one_document(spark):
    rows = [r for r in substrings.remove_repeats(odd(spark)).collect() if r["doc_id"] == 12]
    assert len(rows) == 2 and all(r["n_removed"] == 0 for r in rows)


# language model

def plain_model(rows, learn):
    """Katz backoff of order three, by its definition: ``p(history, word)`` with at most two words of history."""
    tokens = {n: split(ascii_lower(t)) + [None] for n, (i, t) in enumerate(rows)}
    count = collections.Counter()
    for n, (i, _) in enumerate(rows):
        if learn(i):
            count.update(tuple(tokens[n][k:k + m]) for m in (1, 2, 3) for k in range(len(tokens[n]) - m + 1))
    of = [{g: c for g, c in count.items() if len(g) == m} for m in (1, 2, 3)]
    total, words = sum(of[0].values()), len(of[0])
    d = [katz.Discounts.fit([sum(v == r for v in c.values()) for r in range(1, katz.LARGEST + 2)]) for c in of]
    p1 = {w: float(d[0](n)) / total for (w,), n in of[0].items()}
    unknown = 1 - sum(p1.values()) if total else 1.0
    after = collections.defaultdict(list)
    for g in count:
        after[g[:-1]].append(g[-1])
    weight = {}

    def p(history, w):
        if not history:
            return p1.get(w, unknown)
        if (*history, w) in count:
            return float(d[len(history)](count[(*history, w)])) / count[history]
        if history not in after:
            return p(history[1:], w)
        if history not in weight:
            seen = after[history]
            weight[history] = (1 - sum(p(history, x) for x in seen)) / (1 - sum(p(history[1:], x) for x in seen))
        return weight[history] * p(history[1:], w)

    scores = {}
    for n, t in tokens.items():
        score = sum(math.log10(p(tuple(t[max(0, k - 2):k]), w)) for k, w in enumerate(t))
        base = sum(math.log10((count[(w,)] + 1) / (total + words + 1)) for w in t)
        scores[n] = (len(t), sum(count[(w,)] > 0 for w in t), total, base, score)
    return scores, p, [h for h in after if h], [*p1, "unknown word"]


@pytest.mark.parametrize("block, part", [(katz.BLOCK_BYTES, katz.PART_BYTES), (3000, 2000)])
def test_scores_are_those_of_the_plain_model(spark, corpus, documents, monkeypatch, block, part):
    monkeypatch.setattr(katz, "BLOCK_BYTES", block)
    monkeypatch.setattr(katz, "PART_BYTES", part)
    learn = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    want, p, histories, words = plain_model(corpus, learn)
    for h in histories[:20] + [h for h in histories if len(h) == 2][:40]:
        assert sum(p(h, w) for w in words) == pytest.approx(1, abs=1e-9)
    rows = katz.score_documents(documents, ~toxicity.held_out("doc_id", 7, 2)).collect()
    of = {i: want[n] for n, (i, _) in enumerate(corpus)}
    assert len(rows) == len(corpus)
    for r in rows:
        assert tuple(r)[1:4] == of[r["doc_id"]][:3]
        assert tuple(r)[4:] == pytest.approx(of[r["doc_id"]][3:], abs=1e-8)


def test_far_and_missing_ids_and_two_texts_under_one(spark, monkeypatch):
    """Blocks don't depend on ids: a third of the rows without one, one far away, repeated rows, two texts under an id."""
    monkeypatch.setattr(katz, "BLOCK_BYTES", 2000)
    rng = random.Random(3)
    rows = [(None if i % 3 == 0 else i, prose(rng, 30)) for i in range(120)] + [(1 << 60, prose(rng, 20)), (7, "ka lo ka lo"), (None, None)]
    rows += [rows[1]] * 5
    got = katz.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), F.lit(True)).collect()
    want = plain_model([(i, t or "") for i, t in rows], lambda i: True)[0]
    key = lambda x: (x[0] is None, x[0] or 0, round(x[-1], 6))
    expected = sorted({(i, *want[n][:3], round(want[n][3], 6), round(want[n][4], 6)) for n, (i, t) in enumerate(rows)}, key=key)
    assert sorted([(*tuple(r)[:4], round(r["base_score"], 6), round(r["score"], 6)) for r in got], key=key) == expected


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1 << 63), (2, 10), (1000, 1 << 62), (50, 1 << 16)):
        keys = np.unique(rng.integers(0, top, n).astype(np.uint64) + np.uint64(5))
        assert (katz._unpacked(katz._packed(keys)) == keys).all()


def test_a_model_learnt_from_nothing(spark):
    rows = katz.score_documents(odd(spark), F.lit(None).cast("boolean")).collect()
    assert all(r["train_tokens"] == 0 and r["score"] == 0 and r["base_score"] == 0 for r in rows)


def test_a_document_of_several_blocks_backs_off_once(spark, monkeypatch):
    """Copies of a row that are read by different tasks are one document: what its backing off adds counts once."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 40)) for i in range(60)]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    again = once.where("doc_id < 6").coalesce(1)
    learn = F.col("doc_id") % 3 != 0
    want = {r["doc_id"]: tuple(r) for r in katz.score_documents(once.union(again.where(~learn)), learn).collect()}
    plain = plain_model(rows, lambda i: i % 3 != 0)[0]
    assert len(want) == 60
    for i, row in want.items():
        assert row[1:4] == plain[i][:3] and row[4:] == pytest.approx(plain[i][3:], abs=1e-8)


def test_runs_are_sent_in_little_room():
    """Hashes of a block take hardly more than what tells them apart, and small counts next to nothing."""
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 200_000).astype(np.uint64) * np.uint64(2))
    counts = np.where(rng.random(len(keys)) < 0.02, 40, 2).astype(np.uint32)
    assert len(katz._packed(keys)) < 6.3 * len(keys) and len(katz._squeezed(counts)) < 0.1 * len(keys)
    assert (katz._restored(katz._squeezed(counts)) == counts).all()
    shares = rng.random(1000)
    assert (katz._restored(katz._squeezed(shares), "f") == shares).all() and len(katz._restored(katz._squeezed(shares[:0]), "f")) == 0


# benchmark

def test_benchmark_items_are_found_wherever_they_stand(spark):
    rng = random.Random(6)
    items = [(k, prose(rng, n)) for k, n in enumerate([1, 4, 9, 12, 14, 17, 20, 33, 47, 59, 140, 300])]
    docs, want = [], set()
    for k, text in items:
        for shift in range(6):
            copy = text.upper() if shift == 3 else text.replace(" ", ", ") if shift == 4 else text + "%%%" if shift == 5 else text
            docs.append((len(docs), f"{' '.join(f'q{j}' for j in range(shift))} {copy} {' '.join(f'z{j}' for j in range(30))}"))
            want.add((docs[-1][0], k))
    docs += [(len(docs) + j, prose(random.Random(100 + j), 80)) for j in range(20)]
    docs.append((len(docs), items[9][1][:len(items[9][1]) // 2]))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_passages(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()}
    long = {(d, k) for d, k in got if k > 1}
    assert long == {(d, k) for d, k in want if k > 1}


def changed_copy(rng, words, edits):
    """The words with some replaced, put in or left out."""
    out = list(words)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.choice(["replace", "insert", "leave out"])
        out[at:at + (kind != "insert")] = [] if kind == "leave out" else [f"x{rng.randrange(10 ** 9)}"]
    return out


def most_similar(item, words):
    """By reading on from every word: the best Jaccard similarity of five-word shingles."""
    def grams(w):
        return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    best = 0.0
    for begin in range(max(1, len(words) - len(item) + 1)):
        a, b = grams(item), grams(words[begin:begin + len(item)])
        best = max(best, sum((a & b).values()) / sum((a | b).values()))
    return best


def test_changed_copies_are_found_as_by_brute_force():
    rng = random.Random(12)
    items, texts, want = [], [], {}
    for n in (13, 25, 40, 80, 100, 200, 300):
        for edits in [k for k in (1, 2, 4, 6, 8) for _ in range(4) if k <= max(1, n // 30)]:
            own = [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
            around = [[f"y{rng.randrange(10 ** 9)}" for _ in range(rng.randrange(1, 40))] for _ in range(2)]
            words = around[0] + changed_copy(rng, own, edits) + around[1]
            items.append((len(items), " ".join(own).encode()))
            texts.append(" ".join(words).encode())
            best = most_similar(own, words)
            if best >= 0.75:
                want[len(items) - 1] = best
    got = {t: s for t, i, _, s in decontamination.Items(items, decontamination.RADIUS, 0.75).search(texts) if t == i}
    assert len(want) > 30 and sum(s < 1 for s in want.values()) > 30
    assert got == pytest.approx(want)


def test_similarity_does_not_depend_on_passes_or_repeated_items(spark, monkeypatch):
    rng = random.Random(14)
    frame = [f"t{rng.randrange(10 ** 9)}" for _ in range(60)]
    single = [f"w{rng.randrange(10 ** 9)}" for _ in range(45)]
    items = [(0, " ".join(single)), (1, " ".join(single).upper()), (2, ", ".join(single))]
    items += [(10 + k, " ".join(frame + [f"u{k}n{j}" for j in range(20)])) for k in range(5)]
    changed = lambda words, at: " ".join(words[:at] + ["other"] + words[at + 1:])
    docs = [(0, "head " + changed(single, 20) + " tail"), (1, "head " + changed(items[3][1].split(), 30) + " tail")]
    docs, table = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    seen = []
    for size in (20_000, 2, 1):
        monkeypatch.setattr(decontamination, "ITEMS_PER_PASS", size)
        seen.append({(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.find_passages(docs, table).collect()})
    assert set(seen[0]) == {(0, 0), (0, 1), (0, 2), (1, 10)} and seen[1] == pytest.approx(seen[0]) and seen[2] == pytest.approx(seen[0])
    assert seen[0][0, 0] == pytest.approx(36 / 46)
    # 56 shingles of the frame, held by five items, five of them changed; 20 of the item's own
    assert seen[0][1, 10] == pytest.approx((51 / 5 + 20) / (56 / 5 + 20 + 5 / 5))


def test_every_fingerprint_within_the_radius_is_met():
    rng = np.random.default_rng(1)
    held = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    asked = held[rng.integers(0, 300, 2000)].copy()
    for _ in range(6):
        flip = rng.random(2000) < 0.7
        asked[flip] ^= np.uint64(1) << rng.integers(0, 64, flip.sum()).astype(np.uint64)
    got = set(zip(*(x.tolist() for x in decontamination.Blocks(held, 5).within(asked))))
    distance = np.bitwise_count(asked[:, None] ^ held)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(distance <= 5)))) and got


def test_benchmarks_in_passes_and_without_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEMS_PER_PASS", 2)
    rng = random.Random(9)
    items = [(k, prose(rng, 30)) for k in range(7)] + [(7, None), (None, "x y z"), (8, "")]
    docs = spark.createDataFrame([(k, f"head {t} tail", "extra") for k, t in items], "doc_id long, text string, item_id string")
    table = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_passages(docs, table).collect()} == {(k, k) for k in range(7)}
    left = decontamination.drop_contaminated(docs, table)
    assert left.columns == docs.columns and left.count() == 3
    assert decontamination.drop_contaminated(docs, table.limit(0)).count() == docs.count()


# shards

@pytest.mark.parametrize("ranges", [None, 3])
def test_shards_are_contiguous_and_equal(spark, corpus, documents, ranges):
    rows = shards.shard_by_bytes(documents, 8).collect()
    text = dict(corpus)
    place = sorted((r["shard"], r["slot"], r["doc_id"]) for r in rows)
    assert [p[2] for p in place] == sorted(text)
    for k in range(8):
        assert [p[1] for p in place if p[0] == k] == list(range(sum(p[0] == k for p in place)))
    size = {i: len((t or "").encode()) + 1 for i, t in text.items()}
    assert all((r["size"], r["text_crc32"]) == (size[r["doc_id"]], zlib.crc32((text[r["doc_id"]] or "").encode())) for r in rows)
    sums = [sum(size[p[2]] for p in place if p[0] == k) for k in range(8)]
    assert max(sums) - min(sums) <= 2 * max(size.values())


def test_shards_written_and_read(spark, documents, tmp_path):
    shards.write_shards(documents.withColumn("extra", F.lit(1)), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count() and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def test_written_shards_keep_every_column(spark, tmp_path):
    """Columns named like those the cuts need come back as they were."""
    rows = [(i, f"text {i}" * (i % 5), i + 1, "s", 2.0, "n", i, "t", 9) for i in range(50)] + [(None, None, 0, None, None, None, None, None, None)]
    schema = "doc_id long, text string, size int, text_crc32 string, slot double, number string, start long, total string, shard int"
    docs = spark.createDataFrame(rows, schema)
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "shard_"}
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    cuts = {r["doc_id"]: r["shard"] for r in shards.shard_by_bytes(docs.select("doc_id", "text"), 4).collect()}
    assert {r["doc_id"]: r["shard_"] for r in back.collect()} == cuts


def test_cuts_are_those_of_a_plain_sum(spark, corpus, documents):
    """The cuts computed a second time: a row is in the shard that the middle of its bytes falls into."""
    rows = sorted((i, len((t or "").encode()) + 1) for i, t in corpus)
    total, at, want = sum(n for _, n in rows), 0, {}
    for i, n in rows:
        want[i] = min(4, (2 * at + n) * 5 // (2 * total))
        at += n
    assert {r["doc_id"]: r["shard"] for r in shards.shard_by_bytes(documents, 5).collect()} == want


def test_a_count_column_and_a_hot_address(spark):
    rows = [(i, "write to bob.smith@example.com now" if i % 2 else f"call user{i}@mail.org", 7) for i in range(300)]
    got = pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string, n_entities int"), "k", with_count=True).collect()
    assert len(got) == 300 and all(r["n_entities"] == 1 for r in got)
    hot = {r["text"] for r in got if r["doc_id"] % 2}
    rest = {r["text"] for r in got if not r["doc_id"] % 2}
    assert len(hot) == 1 and "bob.smith@example.com" not in hot.pop() and len(rest) == 150


def test_shards_of_one_repeated_row(spark):
    df = spark.createDataFrame([(7, "same")] * 800, "doc_id long, text string").repartition(4)
    counts = collections.Counter(r["shard"] for r in shards.shard_by_bytes(df, 8).collect())
    assert set(counts.values()) == {100}


# packing

def test_pieces_are_the_tokens_in_order(spark, corpus, documents):
    tokenizer = Tokenizer.from_file(TOKENS)
    rows = packing.pack_documents(documents, TOKENS, capacity=64, with_ids=True).collect()
    pieces = collections.defaultdict(dict)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces[r["doc_id"]][r["piece"]] = r
    for i, text in corpus:
        own = [pieces[i][k] for k in range(len(pieces[i]))]
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert [x for r in own for x in r["ids"]] == ids
        assert [r["start"] for r in own] == list(range(0, len(ids), 64))
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by_sequence.values():
        assert [o for o, _ in sorted(own)] == [sum(n for o2, n in own if o2 < o) for o, _ in sorted(own)]
        assert sum(n for _, n in own) <= 64
    assert len(by_sequence) <= 1.1 * sum(r["length"] for r in rows) / 64 + 3


def test_word_ids_are_those_of_whole_texts():
    tokenizer, ids_of = Tokenizer.from_file(TOKENS), packing.WordIds(TOKENS)
    texts = ["a b \x1c c", "éx", "　日本 it's  DON'T\x85x 12345 ²½", "", "<|endoftext|> x", "<|ENDOFTEXT|> X", "x​Y İ ẞ ﬁ", "new words\nand\x0bmore"]
    for _ in range(2):
        ids, counts = ids_of([t.encode() for t in texts])
        ends = np.cumsum(counts)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids_of([t.encode()])[0].tolist() for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_bins_are_those_of_a_plain_packer():
    """Best fit over a list of open bins, the fullest closed past the limit."""
    rng = random.Random(2)
    bins, open_, made = packing.OpenBins(64, 5), [], 0
    for _ in range(3000):
        length = rng.randint(1, 64)
        fitting = [b for b in open_ if b[0] >= length]
        if fitting:
            best = min(b[0] for b in fitting)
            chosen = [b for b in open_ if b[0] == best][-1]
            open_.remove(chosen)
        else:
            chosen, made = (64, made), made + 1
        want = (chosen[1], 64 - chosen[0])
        if chosen[0] > length:
            if len(open_) == 5:
                fullest = min(b[0] for b in open_)
                open_.remove([b for b in open_ if b[0] == fullest][-1])
            open_.append((chosen[0] - length, chosen[1]))
        assert bins.place(length) == want


def test_bytes_that_are_no_text_do_not_stop_it(spark):
    rows = spark.createDataFrame([(1, bytearray(b"good words"), 0), (2, bytearray(b"bad \xff\xfe bytes"), 0)], "doc_id long, raw binary, piece int")
    odd_text = rows.select("doc_id", F.col("raw").cast("string").alias("text"), "piece")
    assert packing.pack_documents(odd_text, TOKENS).count() == 2
    assert substrings.remove_repeats(odd_text, with_text=True).count() == 2


def test_tokenizer_calls_are_bounded():
    """What a call returns is large, so no call gets more than some thousand words, however many are new."""
    from tokenizers import Tokenizer

    class Watched:
        def __init__(self, inner):
            self.inner, self.most = inner, 0

        def encode_batch_fast(self, texts, **options):
            self.most = max(self.most, sum(len(t.split()) for t in texts))
            return self.inner.encode_batch_fast(texts, **options)

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=7)) + ("A" if i % 3 == 0 else "") for i in range(20_000)]
    text, ids_of = " ".join(words), packing.WordIds(TOKENS)
    ids_of.tokenizer, ids_of.plain = Watched(ids_of.tokenizer), Watched(ids_of.plain)
    ids, counts = ids_of([text.encode(), b""])
    assert counts.tolist() == [len(ids), 0]
    assert ids.tolist() == Tokenizer.from_file(TOKENS).encode(text, add_special_tokens=False).ids
    assert 0 < max(ids_of.tokenizer.most, ids_of.plain.most) <= 4_000


def test_word_ids_leave_nothing_behind():
    """A worker makes new ones for each task, so what is not freed with them would grow with the table."""
    class Info(ctypes.Structure):
        _fields_ = [(n, ctypes.c_size_t) for n in "arena ordblks smblks hblks hblkhd usmblks fsmblks uordblks fordblks keepcost".split()]

    info = getattr(ctypes.CDLL(None), "mallinfo2", None)
    if info is None:
        pytest.skip("only glibc tells what is allocated")
    info.restype = Info
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefghijklm", k=9)) + ("A" if i % 2 else "") for i in range(40_000)).encode()

    def held() -> float:
        packing.WordIds(TOKENS)([text])
        gc.collect()
        found = info()
        return (found.uordblks + found.hblkhd) / 1e6

    held()
    before = held()
    for _ in range(3):
        after = held()
    assert after - before < 6  # 25 MB and more with the caches of six tokenizers


def test_best_fit_and_the_fullest_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 9)] == [(0, 0), (1, 0), (1, 7), (2, 0)]
    assert bins.place(8) == (3, 0)  # a third open bin: the fullest (2, one free) is closed
    assert bins.place(1) == (3, 8)
    assert bins.place(4) == (0, 6) and bins.count == 1


def test_surrogates_start_no_python_worker(spark, monkeypatch):
    """Rows made from Python objects are made by workers, which stay beside those of other stages."""
    docs = spark.createDataFrame([(1, "write to a.b@c.org or a.b@c.org"), (2, None)], "doc_id long, text string")

    def refused(*_, **__):
        raise AssertionError("rows from Python objects")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    first, second = pii.replace_entities(docs, "k").orderBy("doc_id").collect()
    assert "a.b@c.org" not in first["text"] and first["text"].startswith("write to ") and second["text"] is None


def test_classifier_is_fitted_in_small_batches(spark, monkeypatch):
    """The rows of the one task that fits are large: some megabytes of them go to the worker at a time."""
    key, seen, settled = "spark.sql.execution.arrow.maxBytesPerBatch", [], toxicity.settled
    monkeypatch.setattr(toxicity, "settled", lambda df, name: seen.append(spark.conf.get(key)) or settled(df, name))
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, "bad words" if i % 2 else "good words") for i in range(40)], "doc_id long, text string")
    toxicity.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert seen and {int(x) for x in seen} == {4 << 20}
    assert spark.conf.get(key) == before


# all of them

@pytest.mark.parametrize("run", [
    jaccard.link_documents, substrings.remove_repeats, licenses.scan_licenses, shards.shard_by_bytes,
    lambda d: katz.score_documents(d, F.lit(True)), lambda d: pii.replace_entities(d, "k"), lambda d: packing.pack_documents(d, TOKENS),
])
def test_empty_and_odd_tables(spark, run):
    assert run(empty(spark)).collect() == []
    ids = {r["doc_id"] for r in run(odd(spark)).collect()}
    assert ids == {r[0] for r in odd_rows()}


def test_the_fit_holds_little_beside_its_entries():
    """Entries come row by row, in order, and what is allocated on the way is near the size of what stays."""
    import tracemalloc

    rng = np.random.default_rng(5)
    places = np.sort(rng.choice(1 << 20, 5000, replace=False))
    ratios = rng.normal(size=5000)
    sizes = rng.integers(0, 1200, 3000)
    feature, value = rng.choice(places, sizes.sum()).astype(np.int32), rng.random(sizes.sum()).astype(np.float32)
    edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(edges, pa.array(x)) for x in (feature, value)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3000) % 2, pa.int32()), *lists], ["label", "feature", "value"])
    tracemalloc.start()
    label, doc, place, scaled = toxicity._gathered(iter([batch.slice(0, 2000), batch.slice(2000, 0), batch.slice(2000)]), places, ratios)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (label == np.arange(3000) % 2).all() and (doc == np.repeat(np.arange(3000), sizes)).all()
    assert (places[place] == feature).all() and (scaled == value * ratios[place].astype(np.float32)).all()
    assert most < 1.7 * (doc.nbytes + place.nbytes + scaled.nbytes)


def test_frequencies_are_counted_in_little_room():
    """Documents of either class that have a feature; beside the two tables little is held, however long the batch."""
    import tracemalloc

    rng = random.Random(6)
    texts = [prose(rng, 150) for _ in range(3000)] + ["", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(len(texts))])], ["text", "_label"])
    list(toxicity._frequencies(iter([batch.slice(0, 10)])))
    tracemalloc.start()
    made = pa.Table.from_batches(list(toxicity._frequencies(iter([batch.slice(0, 1000), batch.slice(1000)]))))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = collections.Counter()
    for i, t in enumerate(texts):
        want.update((f, i % 2) for f in set(toxicity.ngrams([(t or "").encode()])[0].tolist()))
    assert {(r["feature"], k): r[c] for r in made.to_pylist() for k, c in ((0, "clean"), (1, "toxic")) if r[c]} == want
    assert most < 60 << 20


def test_what_a_task_left_is_given_back_before_the_next(monkeypatch):
    seen = []
    monkeypatch.setattr("meterflow.llm.chunks.give_back", lambda: seen.append("given"))

    def batches():
        seen.append("read")
        yield pa.RecordBatch.from_arrays([pa.array(["a", None])], ["text"])

    from meterflow.llm.chunks import texts_in_chunks
    assert [t for _, t in texts_in_chunks(batches(), "text")] == [[b"a", b""]]
    assert seen[:2] == ["given", "read"]


def test_shingle_sets_are_made_in_little_room():
    """The sets of a chunk of 2 MB, as those of its texts one by one; what is held on the way does not go with the chunk."""
    import tracemalloc

    rng = random.Random(9)
    texts = [prose(rng, rng.randrange(700)).encode() for _ in range(1400)] + [b"", b" \t", b"one", b"three words here"]
    assert sum(map(len, texts)) > 19 << 17
    jaccard.shingle_sets(texts)
    tracemalloc.start()
    values, counts = jaccard.shingle_sets(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((a == jaccard.shingle_sets([t])[0]).all() for a, t in zip(jaccard._of(values, counts), texts)) and len(counts) == len(texts)
    assert most < 3 * values.nbytes + (20 << 20)
