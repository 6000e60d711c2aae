"""The operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import (
    bpe,
    chat_format,
    common,
    components,
    decontaminate,
    exact_dedup,
    line_dedup,
    lm_score,
    near_dedup,
    pii,
    toxicity,
    url_filter,
)
from vigil.llm.queries import RULES

WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "hy", "ja", "ke", "lo", "mu")
         for b in ("na", "pe", "ri", "so", "tu", "va", "we", "xi", "yo", "za")]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(rnd: random.Random, n: int) -> list[str]:
    return [rnd.choice(WORDS) for _ in range(n)]


def awkward_texts() -> list[str | None]:
    rnd = random.Random(5)
    base = [" ".join(words(rnd, rnd.randint(20, 60))) for _ in range(12)]
    line = "The same very long boilerplate line stands in many documents."
    texts: list[str | None] = [None, "", " \n\t ", "a", "A", "word " * 3, "é É ß ñ", "x" * 5000]
    texts += base + [t.upper() for t in base[:3]]
    texts += [t + " tail" for t in base[:4]] + [base[0]] * 3
    texts += [f"{line}\n{t}\n  {line.upper()} \n" for t in base[4:10]]
    texts.append("\n".join(base) * 10)
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 7, t, "x", i) for i, t in enumerate(awkward_texts())]
    rows += [(14, rows[2][1], "again", 1), (None, "a lost text", None, None), (None, None, None, 2)]
    rows += [(3000, "repeated row", "r", 0)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, rid long")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, digest string, rid long")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def lower(text):
    return (text or "").encode().lower().decode()


# --- op1 -----------------------------------------------------------------------------

BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    def digits(s):
        return re.sub(r"\D", "", s)

    def luhn(s):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(s[::-1])) % 10 == 0

    checks = [lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
              lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s)),
              lambda s: 9 <= len(digits(s)) <= 15]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(zip(BASE, checks))
                  for m in re.finditer(p, text) if ok(m.group()))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-+ 0149()%é\n", max_size=60))
def test_pii_base_is_leftmost_matching(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_pii_added_kinds_and_long_runs():
    text = "IBAN GB82 WEST 1234 5698 7654 32, ssn 123-45-6789; call 030 1234 5678. 123-45-6788"
    found = [(k, text[a:b]) for a, k, b, _ in pii.find_spans(text) if k in pii.ADDED_KINDS]
    assert found == [("iban", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789"),
                     ("phone_local", "030 1234 5678"), ("ssn", "123-45-6788")]
    assert not pii.find_spans("GB82 WEST 1234 5698 7654 33")
    for run in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+" * 100_000, "1." * 100_000):
        pii.find_spans(run)  # linear time


def test_pii_rows(docs, empty):
    rows = pii.detect(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in pairs(docs))
    assert pii.detect(empty).count() == 0


# --- op2 -----------------------------------------------------------------------------

def test_exact_dedup_brute_force(spark, docs, empty):
    index = exact_dedup.DigestIndex.scratch(spark)
    rows = index.ingest(docs, "one")
    own = {(i, lower(t)) for i, t in pairs(docs)}
    groups: dict[str, list] = {}
    for i, t in own:
        groups.setdefault(t, []).append(i)
    want = set()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).digest()
        want |= {(i, sha, keep, len(ids), i == keep) for i in ids}
    got = [(r.doc_id, bytes(r.digest), r.keep_id, r.group_size, r.kept) for r in rows.collect()]
    assert len(got) == len(want) and set(got) == want
    n = index.frame().count()
    assert n == len(groups)
    # a repeated batch changes nothing; a later batch keeps only what is new
    assert set(map(tuple, index.ingest(docs, "one").collect())) == set(map(tuple, rows.collect()))
    assert index.frame().count() == n
    more = spark.createDataFrame([(9000, "A"), (9001, "new"), (9002, "NEW")], "doc_id long, text string")
    kept = index.ingest(more, "two").filter("kept").collect()
    assert [r.doc_id for r in kept] == [9002] and index.frame().count() == n + 1
    assert index.ingest(empty, "three").count() == 0


def test_exact_dedup_keeps_whole_rows(spark, docs):
    kept = exact_dedup.kept_documents(docs, exact_dedup.DigestIndex.scratch(spark), "b")
    assert kept.columns == docs.columns
    got = [lower(t) for _, t in pairs(kept)]
    assert sorted(got) == sorted({lower(t) for _, t in pairs(docs)})
    assert [r.digest for r in kept.filter("doc_id = 3000").collect()] == ["r"]


# --- op3 -----------------------------------------------------------------------------

def cheapest(roles):
    """Cost by trying every sequence of states."""
    best = math.inf
    for states in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, state = 0, 0
        for role, after in zip(roles, states):
            cost += chat_format.MOVES[role][state][after][0]
            state = after
        best = min(best, cost + (0, 4, 2, 0)[state])
    return best


def test_chat_repair_is_cheapest_and_legal(spark):
    rnd = random.Random(1)
    names = ["user", "assistant", "system", " User ", "tool", None]
    rows = [(c, t, rnd.choice(names), f"{c}.{t}") for c in range(25) for t in range(rnd.randint(1, 6))]
    rows += [(None, None, "user", None), (None, 1, "assistant", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.repair(table).collect()
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is None, r[1]))
        got = sorted((r for r in out if r.conv_id == c), key=lambda r: r.seq)
        assert sum(r.cost for r in got) == cheapest([chat_format.role_number(r[2]) for r in mine])
        given_roles = re.findall(r"<\|(system|user|assistant)\|>", "".join(r.rendered for r in got))
        rest = given_roles[given_roles[0] == "system":]
        assert rest == ["user", "assistant"] * (len(rest) // 2) and rest
        assert "".join(r.rendered for r in got).endswith("<|end|>\n")


def test_chat_one_conversation_over_many_tasks(spark):
    rnd = random.Random(2)
    rows = [(7, t, rnd.choice(["user", "user", "assistant", "system", "bot"]), f"t{t}")
            for t in range(400)] + [(8, 0, "assistant", "y")] + [(9, 1, "user", "same")] * 30
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in (1, 4, 23):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(tuple, chat_format.repair(table).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    assert chat_format.repair(table.limit(0)).count() == 0


# --- op4 -----------------------------------------------------------------------------

def test_line_dedup_brute_force(docs, empty):
    own = pairs(docs)
    strip = " \t\n\x0b\x0c\r"
    keys = [[lower(x.strip(strip)) for x in (t or "").split("\n")] for _, t in own]
    holders: dict[str, list[int]] = {}
    for n, ks in enumerate(keys):
        for k in set(ks):
            holders.setdefault(k, []).append(n)
    want = []
    for (i, t), ks in zip(own, keys):
        kept = []
        for line, k in zip((t or "").split("\n"), ks):
            many = len(k) >= 40 and len(holders[k]) >= 5
            owner = max((own[n][0] for n in holders[k] if own[n][0] is not None), default=None)
            if not many or i == owner:
                kept.append(line)
        want.append((i, len(ks), len(ks) - len(kept), "\n".join(kept)))
    got = list(map(tuple, line_dedup.dedup_lines(docs).collect()))
    assert Counter(got) == Counter(want)
    assert sum(r[2] for r in want) > 5
    assert line_dedup.dedup_lines(empty).count() == 0


# --- op5 -----------------------------------------------------------------------------

def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.COM/en/1?x", "https://www.example.com/en/2", "ftp://x.net/fr/é#y",
            "http://net/es/", "http://notnet/es/", "no scheme/en/", None, "", "a://b://c/d",
            "http://example.com", "http://x.com//en/", "http://x.net/fr"]
    table = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_filter.judge(table, RULES).collect()}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert got[2] == ("x.net", "/fr/é", "net/fr/", "block")
    assert got[3] == ("net", "/es/", "net/es/", "block")
    assert got[4] == ("notnet", "/es/", None, "allow")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("b:", "//c/d", None, "allow")
    assert got[9] == ("example.com", "", None, "allow")
    assert got[10] == ("x.com", "//en/", "com/", "allow")
    assert got[11][2:] == (None, "allow")
    assert url_filter.judge(table.limit(0), RULES).count() == 0


def test_url_templates_spread_labels(spark):
    rows = [(f"http://h.org/spam/{i}.html", True if i < 6 else None) for i in range(20)]
    rows += [(f"http://h.org/junk/{i}.html", True if i < 4 else None) for i in range(9)]
    rows += [(f"http://h.org/good/{i}.html", False if i < 6 else None) for i in range(20)]
    rows += [(f"http://h.org/tag/{w}", None if n % 2 else True) for n, w in enumerate(WORDS[:60])]
    rows += [("http://h.org/" + "/".join(WORDS[:30]), None)] * 2
    table = spark.createDataFrame([(n, u, b) for n, (u, b) in enumerate(rows)],
                                  "page_id long, url string, bad boolean")
    out = url_filter.judge(table, [], bad=F.col("bad")).collect()
    verdicts = {(rows[r.page_id][0].split("/")[3], r.verdict) for r in out}
    assert verdicts == {("spam", "block"), ("junk", "block"), ("good", "allow"), ("tag", "block"),
                        (WORDS[0], "allow")}
    assert {r.template for r in out if "/tag/" in rows[r.page_id][0]} == {"tag/*"}


# --- op6 -----------------------------------------------------------------------------

def brute_tiles(doc, item, k):
    """Greedy string tiling by looking at all pairs of places."""
    doc, item, tiles = list(doc), list(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and item[i + n] >= 0):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < k:
            return tiles
        tiles.append((d, i, n))
        doc[d:d + n], item[i:i + n] = [-2] * n, [-3] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=20),
       st.integers(1, 4))
def test_tiling_brute_force(doc, item, k):
    got = decontaminate.tile(np.array(doc, np.int64), np.array(item, np.int64), k)
    assert got == brute_tiles(doc, item, k)


def test_decontamination(spark, docs, empty):
    rnd = random.Random(9)
    items = [" ".join(words(rnd, 30)) for _ in range(6)] + ["too short", "", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    w = items[2].split()
    reordered = " ".join(["x", *w[20:], "y", *w[:10], "z", *w[10:20]])
    rows = [(1, "zz " * 50 + items[0].upper() + "!"), (2, reordered), (3, " ".join(w[:12])),
            (4, "too short"), (5, None), (6, " ".join(words(rnd, 3000))), (None, items[1])]
    table = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, coverage double")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, bench).collect()}
    assert hits == {(1, 0), (2, 2), (None, 1)}
    kept = decontaminate.kept_documents(table, bench)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 6}
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0
    assert decontaminate.kept_documents(table, bench.limit(0)).count() == len(rows)


def test_decontamination_in_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    items = [" ".join(words(rnd, 20)) for _ in range(7)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    table = spark.createDataFrame([(i, "a b c " + t) for i, t in enumerate(items)],
                                  "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    hits = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, bench).collect()}
    assert hits == {(i, i) for i in range(7)}
    assert decontaminate.kept_documents(table, bench).count() == 0


# --- op7 -----------------------------------------------------------------------------

def brute_segments(weights):
    """Maximal-scoring segments by the definition: the best one, then left and right."""
    best = None
    for a in range(len(weights)):
        for b in range(a + 1, len(weights) + 1):
            s = sum(weights[a:b])
            if s > 0 and (best is None or s > best[2] or (s == best[2] and b - a < best[1] - best[0])):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    return (brute_segments(weights[:a]) + [best]
            + [(x + b, y + b, z) for x, y, z in brute_segments(weights[b:])])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -1.5, -1.0, 0.7, 1.1, 2.3]), max_size=14))
def test_maximal_segments(weights):
    weights = [w + 1e-3 * i for i, w in enumerate(weights)]  # no ties
    got = toxicity.maximal_segments(np.array(weights))
    want = brute_segments(weights)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxicity_learns_and_handles_nothing(spark, docs, empty):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = words(rnd, 60)
        if bad:
            for _ in range(4):
                text.insert(rnd.randrange(60), rnd.choice(["vile", "scorn", "hateful"]))
        rows.append((i, " ".join(text), "toxic"))
        labels.append((i, 1, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, marks)
    got = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    right = sum((got[i] >= 0.5) == (i % 5 == 0) for i in got)
    assert right >= 0.98 * len(got)
    kept = toxicity.kept_documents(table, model)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i] < 0.5}
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(table, marks.limit(0))
    assert max(r.score for r in toxicity.score(table, none).collect()) < 1e-6
    assert toxicity.fit(empty, marks).weights == {}


# --- op8 -----------------------------------------------------------------------------

def test_lm_score_base_and_normalisation(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 30)  # most words take the join
    held = common.fold(F.col("doc_id")) == 1
    got = lm_score.score(docs, held).collect()
    own = pairs(docs)
    out = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in own]
    counts: Counter = Counter()
    for (_, t), h in zip(own, out):
        if not h:
            counts.update(lm_score.normal(t).split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, t), h in zip(own, out):
        ws = lm_score.normal(t).split() + [b""]
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        want.append((i, h, len(ws), sum(counts.get(w, 0) > 0 for w in ws), n, round(base, 6)))
    assert Counter(want) == Counter((*r[:5], round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_score.score(empty, held).count() == 0


def test_mixing_does_not_depend_on_the_batch():
    rnd = random.Random(8)
    texts = [" ".join(words(rnd, n)).encode() for n in (0, 1, 3, 50, 700)] + [b""]
    code = lm_score.huffman(np.random.default_rng(0).integers(0, 50, (257, 257)))
    tables = [np.random.default_rng(1).integers(-60, 60, n).astype(np.int8)
              for n in lm_score._sizes(code)]
    together = lm_score.mixed_log10(lm_score.decisions(texts, code), tables)
    alone = [lm_score.mixed_log10(lm_score.decisions([t], code), tables)[0] for t in texts]
    assert np.allclose(together, alone)


def test_probabilities_of_all_next_symbols_sum_to_one():
    code = lm_score.huffman(np.arange(257 * 257).reshape(257, 257) % 999)
    tables = [np.random.default_rng(2).integers(-99, 99, n).astype(np.int8)
              for n in lm_score._sizes(code)]
    start = b"abc "
    whole = lm_score.mixed_log10(lm_score.decisions([start], code), tables)[0]
    # every text is start + more bytes or ends there: two levels of that must fit in one
    first = [bytes([b]) for b in range(256)]
    d = lm_score.decisions([*first, b""], code)
    ends = np.cumsum(d.bits_of)
    assert whole < 0
    total = 0.0
    for i in range(257):  # cut after the first symbol of each text
        n = int(code.length[lm_score.END * 257 + i])
        begin = int(ends[i] - d.bits_of[i])
        part = lm_score.Decisions([s[begin:begin + n] for s in d.slots], d.bit[begin:begin + n],
                                  np.array([n]))
        total += 10 ** lm_score.mixed_log10(part, tables)[0]
    assert total == pytest.approx(1, abs=2e-3)


# --- op9 -----------------------------------------------------------------------------

def brute_components(own, k, percent):
    sets = []
    for _, t in own:
        w = lower(t).encode().split()
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
    parent = list(range(len(own)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(own)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    ids: dict[int, list] = {}
    for n, (i, _) in enumerate(own):
        ids.setdefault(root(n), []).append(i)
    out = []
    for n, (i, _) in enumerate(own):
        smallest = min((x for x in ids[root(n)] if x is not None), default=None)
        out.append((i, len(sets[n]), smallest, i == smallest))
    return out


def test_near_dedup_brute_force(spark, docs, empty):
    for k, percent in ((3, 85), (5, 80)):
        got = near_dedup.NearDuplicates(docs, k, percent).documents()
        got = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
        assert Counter(map(tuple, got)) == Counter(brute_components(pairs(docs), k, percent))
    assert near_dedup.NearDuplicates(empty).documents().count() == 0


def test_near_dedup_large_group_and_chain(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 6)
    monkeypatch.setattr(near_dedup, "SALT_ROWS", 8)
    monkeypatch.setattr(common, "LEAST_HEAVY", 3)
    rnd = random.Random(6)
    base, rows = words(rnd, 120), []
    for i in range(90):  # a chain: each differs from the one before by one word
        rows.append((i, " ".join(base)))
        base[rnd.randrange(120)] = rnd.choice(WORDS) + "q"
    rows += [(1000 + i, " ".join(words(rnd, 50))) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.NearDuplicates(table, 3, 85).documents()
    got = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == Counter(brute_components(rows, 3, 85))
    kept = near_dedup.kept_documents(table, 3, 85)
    assert kept.columns == table.columns and kept.count() == sum(r.kept for r in got)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    rnd = random.Random(1)
    rnd.shuffle(links)
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r.root for r in got if r.node <= 40}) == 1
    assert len({r.root for r in got if r.node >= 100}) == 1
    assert len(got) == 41 + 30
    assert len({r.root for r in got}) == 2


# --- op10 ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference():
    tokens = bpe.load_ranks(VOCABULARY)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={t: i for i, t in enumerate(tokens)})
    return encoding, bpe.Encoder(tokens, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(
    ["aaaaaaaaaaaa", "  \n\n  x", "\u00a0\u2003", "'s'll", "<|endoftext|>", "1234567", "\x1c\x1d"])),
    max_size=8))
def test_bpe_equals_library(reference, parts):
    encoding, encoder = reference
    text = " ".join(parts)
    ids = encoder.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_bpe_early_lower_rank_finishes_alone():
    """A merge that gives rise to a lower rank than its own must be followed by it."""
    tokens = [b"a", b"b", b"c", b"abc", b"ab"] + [bytes([b]) for b in range(256) if b not in b"abc"]
    table = bpe.MergeTable(tokens)
    word = b"ababcabab"
    want = table.alone([table.rank[bytes([b])] for b in word])
    assert table.replay([word])[word] == want


def test_bpe_rows(reference, docs, empty):
    encoding, _ = reference
    out = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, decode=True)
    got = Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in out.collect())
    want = Counter((i, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes(),
                    (t or "").encode()) for i, t in pairs(docs))
    assert got == want
    back = bpe.decode(out.select("doc_id", "ids"), VOCABULARY).collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t in pairs(docs))
    assert bpe.encode(empty, VOCABULARY, public_tokenizers.PATTERN).count() == 0
