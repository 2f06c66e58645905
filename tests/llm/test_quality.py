"""Quality rules and the quality classifier against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dossierlake.llm import quality_bayes, quality_rules
from tests.llm.data import TEXTS, documents, labels, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    repeated = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, again = len(words), len(repeated)
    failed = n < 20 or 100 * again > 30 * n
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), again, failed
    )


CASES = TEXTS + [
    (20, "a b c d e f g h " * 3 + prose(4, 40)),
    (21, "same line here\nother\nsame line here\nsame line here\n\n\n"),
    (22, "#a $b %c& |<>| **"),
    (23, " ".join("one two three four five six seven eight".split() * 9)),
]


def test_rules_equal_plain_counts(spark):
    rows = quality_rules.apply_rules(documents(spark, CASES), labels(spark)).collect()
    got = Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
         r["base_failed"]) for r in rows
    )
    assert got == Counter((doc, *plain_counts(text)) for doc, text in CASES)
    assert all(not r["kept"] for r in rows if r["base_failed"])
    assert quality_rules.apply_rules(documents(spark, []), labels(spark, [])).count() == 0


def plain_bin(gram):
    x = int.from_bytes(gram, "little") * 0x9E3779B1 & 0xFFFFFFFF
    x ^= x >> 15
    return (x * 0x85EBCA77 & 0xFFFFFFFF) >> (32 - quality_rules.BIN_BITS)


def test_log_ratio_equals_plain_version(spark):
    docs = [(i, prose(i, 60) if i % 3 else "JUNK!! " * 3 + prose(i, 30).upper()) for i in range(12)]
    marks = [(i, int(i % 3 > 0), 0) for i in range(8)]
    target, corpus = Counter(), Counter()
    for i, text in docs:
        raw = text.encode()
        grams = Counter(plain_bin(raw[k : k + 4]) for k in range(len(raw) - 3))
        corpus += grams
        if (i, 1, 0) in marks:
            target += grams
    size = 1 << quality_rules.BIN_BITS
    t, c = sum(target.values()) + size, sum(corpus.values()) + size
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(documents(spark, docs), labels(spark, marks)).collect()}
    for i, text in docs:
        raw = text.encode()
        total = n = 0
        for k in range(len(raw) - 3):
            b = plain_bin(raw[k : k + 4])
            total += round((math.log((target[b] + 1) / t) - math.log((corpus[b] + 1) / c)) * quality_rules.SCALE)
            n += 1
        assert got[i]["score"] == pytest.approx(total / n / quality_rules.SCALE, abs=2e-4)
        kept = total / n / quality_rules.SCALE >= quality_rules.THRESHOLD and not plain_counts(text)[-1]
        assert got[i]["kept"] == kept


def test_verdicts_do_not_depend_on_the_share_of_a_language(spark):
    """Clean texts of a language with little trusted text are kept, junk is not, at any size."""
    for n in (40, 240):
        rows, marks = [], []
        for i in range(n):
            few = i % 4 == 0
            text = prose(i, 100).replace("w", "zu") if few else prose(i, 100, 300)
            if i % 10 == 9:
                text = text.upper().replace(" ", "!? ")
            rows.append((i, text, "de" if few else "en"))
            if i % 10 != 9 and (i % 8 == 0 or not few):
                marks.append((i, 1, 0))
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs, labels(spark, marks), lang_col="lang").collect()}
        assert not any(got[i] for i in range(9, n, 10))
        assert all(got[i] for i, _, _ in marks)
        clean = [got[i] for i in range(4, n, 8) if i % 10 != 9]
        assert sum(clean) >= 0.8 * len(clean)


def test_language_without_trusted_documents_has_the_threshold_of_all(spark):
    rows = [(i, prose(i, 60), "en" if i < 40 else None) for i in range(60)]
    rows += [(i, prose(i, 60).replace("w", "qx"), None) for i in range(60, 70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = labels(spark, [(i, 1, 0) for i in range(40)])
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs, marks, lang_col="lang").collect()}
    assert sum(got[i] for i in range(40, 60)) >= 16
    assert not any(got[i] for i in range(60, 70))
    none = quality_rules.apply_rules(docs, marks.limit(0), lang_col="lang").collect()
    assert all(r["kept"] != r["base_failed"] for r in none)


def test_slices_change_nothing():
    raw = [(t or "").encode() for _, t in CASES]
    ratios = np.arange(1 << quality_rules.BIN_BITS, dtype=np.int32) % 977 - 400
    ends = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    whole = quality_rules.measure(data, ends, ratios)
    for i, x in enumerate(raw):
        one = quality_rules.measure(np.frombuffer(x, np.uint8), np.array([0, len(x)]), ratios)
        assert all(one[k][0] == whole[k][i] for k in whole)


def test_classifier_posteriors_equal_plain_version(spark):
    rows = [(i, f"h{i % 3}", f"p{i % 2}", (i % 7 - 3) / 2) for i in range(40)] + [(99, "", "", 0.3)]
    frame = spark.createDataFrame(rows, "id bigint, host string, path string, logit double")
    got = {r["id"]: r for r in quality_bayes.posteriors(frame, 0.7).collect()}
    p = {i: 1 / (1 + math.exp(-x)) for i, _, _, x in rows}
    mean = sum(p.values()) / len(p)
    hosts, sites = defaultdict(list), defaultdict(list)
    for i, h, s, _ in rows:
        hosts[h].append(p[i])
        sites[h, s].append(p[i])

    def strength(groups, centre):
        n = len(p)
        apart = sum(len(g) * (sum(g) / len(g) - centre(k)) ** 2 for k, g in groups.items()) / n
        real = max(apart - mean * (1 - mean) * len(groups) / n, 1e-9)
        return min(max(mean * (1 - mean) / real - 1, 2.0), 10_000.0)

    k = strength(hosts, lambda _: mean)
    post = {h: (k * mean + sum(g)) / (k + len(g)) for h, g in hosts.items()}
    k = strength(sites, lambda s: post[s[0]])
    for i, h, s, x in rows:
        others = (k * post[h] + sum(sites[h, s]) - p[i]) / (k + len(sites[h, s]) - 1)
        odds = x + math.log(others / (1 - others)) - math.log(0.7 / 0.3)
        assert got[i]["host_posterior"] == pytest.approx(post[h])
        assert got[i]["path_posterior"] == pytest.approx(others)
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_classifier_tells_junk(spark):
    texts = [(i, prose(i, 80) if i % 2 else prose(i, 80).upper().replace(" ", "!! ")) for i in range(60)]
    marks = [(i, i % 2, 0) for i in range(40)]
    rows = quality_bayes.classify(documents(spark, texts), labels(spark, marks)).collect()
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in rows) and len(rows) == 60


def test_classifier_bears_odd_rows(spark):
    rows = quality_bayes.classify(documents(spark), labels(spark)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in TEXTS)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality_bayes.classify(documents(spark), labels(spark, [])).count() == len(TEXTS)
    assert quality_bayes.classify(documents(spark, []), labels(spark)).count() == 0
