"""Every stage of the pipeline against a second version in plain Python, on edge cases and on
the smallest tables."""

import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from rigpulse.llm import bpe, langid, packing, quality, secret_scan
from tests.llm.test_operators import SF, docs, labels, shingles, words  # noqa: F401

COLUMNS = ("doc_id", "text", "lang", "source")


def kept(rows):
    return Counter(tuple(r[c] for c in COLUMNS) for r in rows)


def probabilities(net, text):
    """One byte after the other through both layers, in double precision."""
    def hard(x):
        return np.clip(0.25 * x + 0.5, 0, 1)

    def layer(d, data):
        u, k = net.recurrent[d].astype(float), langid.HIDDEN
        h, out = np.zeros(k), []
        for byte in data if d == 0 else reversed(data):
            x = net.table[d][:, byte].astype(float)
            z, r = hard(x[:k] + u[:k] @ h), hard(x[k : 2 * k] + u[k : 2 * k] @ h)
            a = x[2 * k :] + u[2 * k :] @ (r * h)
            h = (1 - z) * h + z * a / (1 + np.abs(a))
            out.append(h)
        return out if d == 0 else out[::-1]

    data, total = text.encode(), np.zeros(len(net.languages))
    for at in range(0, len(data), langid.WIDTH):
        window = data[at : at + langid.WIDTH]
        full = window.ljust(langid.WIDTH, b"\0")
        for there, back, _ in zip(layer(0, full), layer(1, full), window):
            scores = net.output.astype(float) @ np.concatenate([there, back]) + net.bias
            total += scores - scores.max() - np.log(np.exp(scores - scores.max()).sum())
    mean = np.exp(total / len(data) - (total / len(data)).max())
    return mean / mean.sum()


def letters(text):
    return any(c.isalpha() for c in text or "")


def test_scores_of_a_second_forward_pass(docs):  # noqa: F811
    net = langid.fit(docs)
    got = {r.text: r for r in langid.predicted(docs.select("text"), net).collect()}
    for text, r in got.items():
        if not letters(text):
            assert (r._lang_pred, r._score) == ("und", 0)
        else:
            p = probabilities(net, text)
            assert r._lang_pred == net.languages[int(p.argmax())]
            assert abs(r._score - p.max()) < 1e-3


@pytest.mark.parametrize("number", [2, 4, 30])
def test_bound_goes_with_the_number_of_languages(number):
    """Texts of every language stay, however many are learned; the bound lies above chance."""
    r = np.random.default_rng(number)
    texts, names = [], []
    for k in range(number):
        own = ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(12)]
        for _ in range(14):
            texts.append(" ".join(r.choice(own, 80)))
            names.append(f"l{k:02d}")
    learned = [i for i in range(len(texts)) if i % 14 < 10]
    net = langid.train([texts[i] for i in learned], [names[i] for i in learned])
    least = langid.least_score(net, [texts[i] for i in learned], [names[i] for i in learned])
    assert 1 / number < least < 1
    best = [probabilities(net, t).max() for i, t in enumerate(texts) if i % 14 >= 10]
    assert np.mean([b >= least for b in best]) > 0.97


def test_bound_without_a_right_text():
    net = langid.train(["aaa aaa", "bbb bbb"], ["x", "y"])
    assert langid.least_score(net, [], []) == 0.5


def statistics(text):
    """The features of the learned list."""
    w, t = words(text), text or ""
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {p for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines, seen = 0, set()
    for line in t.split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    n, chars = max(1, len(w)), max(1, len(t))
    kinds = [unicodedata.category(c) for c in t]
    upper, letter = kinds.count("Lu"), sum(k[0] == "L" for k in kinds)
    base = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return base, {
        "words": float(len(w)), "word_length": sum(map(len, w)) / n,
        "symbols_per_word": sum(c in "#*$%&|<>" for c in t) / n, "repeated_share": len(again) / n,
        "distinct_share": len(set(w)) / n, "dup_lines": float(lines),
        "upper_share": upper / max(1, letter), "letter_share": letter / chars,
    }


def good(text, rules):
    base, x = statistics(text)
    holds = [all((x[c.feature] >= c.edge) == c.above for c in rule) for rule in rules.rules]
    return not base and not any(holds)


def first_of_groups(rows):
    """The rows that stay when those linked by chains keep the one with the least id."""
    known = [shingles(r.text) for r in rows]
    holders = {}
    for i, s in enumerate(known):
        for g in s:
            holders.setdefault(g, []).append(i)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, s in enumerate(known):
        for j, common in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * common >= 75 * len(s | known[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None and known[i]:
            least[root(i)] = min(r.doc_id, least.get(root(i), r.doc_id))
    gone = {r.doc_id for i, r in enumerate(rows) if known[i] and r.doc_id != least.get(root(i))}
    return [r for r in rows if r.doc_id is None or r.doc_id not in gone]


def cleaned(text):
    """Every span of every rule, united where they overlap, replaced by the mark."""
    if text is None:
        return None
    found = []
    for rule in secret_scan.RULES:
        for m in re.compile(rule.pattern, re.A).finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), m.end()))
    out, at = "", 0
    for a, b in sorted(found):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def check_packing(rows, got):
    encoder = bpe.load(bpe.vocabulary_path())
    pieces = Counter()
    for r in rows:
        n = len(encoder.encode(r.text or "")) + 1
        first = n % packing.SIZE or min(n, packing.SIZE)
        starts = [0, *range(first, n, packing.SIZE)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
            pieces[(r.doc_id, k, b - a)] += 1
    assert Counter((r.doc_id, r.piece, r.length) for r in got) == pieces
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= packing.SIZE
    # Best fit leaves at most one sequence more than half empty.
    assert sum(2 * sum(n for _, n in held) <= packing.SIZE for held in by.values()) <= 1


def run_stages(spark, rows, folder, out):
    """All stages, each compared with its second version over what the one before it kept."""
    for name, stage in corpus_pipeline.STAGES:
        before = rows.collect()
        made = stage(spark, rows, folder)
        if name != "packing":
            assert made.columns == rows.columns, name
        made.write.parquet(f"{out}/{name}")
        now = spark.read.parquet(f"{out}/{name}")
        after = now.collect()
        if name == "language":
            net, least = langid.calibrated(rows)
            stay = [r for r in before if letters(r.text) and probabilities(net, r.text).max() >= least]
            assert kept(after) == kept(stay)
        elif name == "quality":
            learned = quality.fit(rows, spark.read.parquet(f"{folder}/labels.parquet"))
            assert kept(after) == kept(r for r in before if good(r.text, learned))
        elif name == "near_duplicates":
            assert kept(after) == kept(first_of_groups(before))
        elif name == "secrets":
            want = Counter((r.doc_id, cleaned(r.text), len(cleaned(r.text) or "")) for r in before)
            assert Counter((r.doc_id, r.text, len(r.text or "")) for r in after) == want
        else:
            check_packing(before, after)
        rows = now
    return after


def test_stages_on_edge_cases(spark, docs, labels, tmp_path):  # noqa: F811
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert run_stages(spark, docs, str(tmp_path), tmp_path)


@pytest.mark.parametrize("name", ["quality", "secrets", "packing"])
def test_stage_alone_on_edge_cases(spark, docs, labels, tmp_path, name, monkeypatch):  # noqa: F811
    """Stages meet null, empty and repeated texts that earlier ones would have taken away."""
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] == name])
    run_stages(spark, docs, str(tmp_path), tmp_path)


def test_stages_on_tables(spark, tmp_path):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert run_stages(spark, documents, SF, tmp_path)


def test_stages_on_empty_tables(spark, docs, labels, tmp_path):  # noqa: F811
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs.limit(0), str(tmp_path))
        assert made.count() == 0, name
