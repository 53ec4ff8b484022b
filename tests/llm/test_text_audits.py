"""Source divergence, spelling variants and benchmark contamination against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rigpulse.llm import decontam, divergence, spelling, tally
from rigpulse.llm.queries import llm_oracles, llm_queries
from tests.oracle_check import connect, differences

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def generated(seed=0, rows=90):
    """Few words of several kinds, so that counts, ties and near words are frequent."""
    r = np.random.default_rng(seed)
    stems = "traveller modeling Ärgerlich élèvesé naïveté abcdef abcdeg abcdefg colour zzzzzz".split()
    words = stems + ["".join(r.choice(list("abcdé"), 6)) for _ in range(60)] + ["中文", "x1y", "a", "I"]
    out = []
    for i in range(rows):
        text = " ".join(r.choice(words, int(r.integers(0, 60))))
        out.append((i, text, ("en", "fr", None)[i % 3], f"s{int(r.integers(0, 4))}"))
    out += [(1, None, "en", None), (1, "", "xx", "lone"), (None, "abcdef " * 40, "en", "s1")]
    out += [out[5], out[5], (900, "traveller " * 3000, "en", "s0"), (901, "x" * 5000, "en", "s0")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(generated(), SCHEMA)
    for name in ("n", "term", "word", "size", "digest", "number", "cell", "item", "value", "rank"):
        made = made.withColumn(name, F.lit("clash"))
    return made.repartition(5)


def audited(rows, least=10, top=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = term.findall(lower(text))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    want = Counter()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)
        groups = {s: c for (l, s), c in counts.items() if l == lang}
        total = sum(groups.values(), Counter())

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        shares = {s: p(c) for s, c in groups.items()}
        q = p(total)
        for s, mine in shares.items():
            pairs = [(-sum((mine[t] - o[t]) ** 2 // (mine[t] + o[t]) for t in kept), b)
                     for b, o in shares.items() if b != s]
            terms = [(-((mine[t] - q[t]) ** 2 // (mine[t] + q[t])), t)
                     for t in kept if groups[s][t] and mine[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                for rank, (value, item) in enumerate(found, 1):
                    want[lang, s, part, item, -value, rank] += 1
    return want


@pytest.mark.parametrize("postings,values", [(divergence.SLICE_POSTINGS, divergence.ROW_BLOCK_VALUES), (7, 5)])
def test_divergence(docs, postings, values):
    """In one slice, and in many slices and blocks of rows."""
    got = divergence.audit(docs, slice_postings=postings, row_values=values)
    assert Counter(tuple(r) for r in got.collect()) == audited(generated())


def test_divergence_without_common_terms(spark):
    rows = [(1, "alpha beta", "en", "a"), (2, "gamma", "en", "b"), (3, None, "en", "c")]
    got = Counter(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == audited(rows) and sum(got.values()) == 6


def test_shares_are_exact_for_large_counts():
    for n, total, kept in ((0, 0, 1), (10**13, 3 * 10**14, 10**7), (5, 9, 2), (10**14, 10**14, 3)):
        want = 1 + 10**9 * (n + 2) // (total + 2 * kept)
        assert divergence.shares(np.array([n]), np.array([total]), kept)[0] == want


def spelled(rows):
    total = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += 1
    words = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [o for o in words if near(w, o)] for w in words}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    want = Counter()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        want[w, form[w], root, n, len(close[w]), words.get(form[w])] += 1
    return want


def chained():
    """A chain of forms, each far more frequent than the last, and many variants of one word."""
    chain = ["abcdefgh", "abcdefg", "abcdefz", "abcdez"]
    rows = [(i, f"{w} " * 5 * 6**k, "en", "s") for i, (k, w) in enumerate(enumerate(chain))]
    base = "qwertyuiop"
    variants = [base[:i] + c + base[i + 1 :] for i in range(10) for c in "abcdé"]
    rows.append((50, " ".join(v for v in variants for _ in range(5)), "en", "s"))
    rows.append((51, f"{base} " * 3000 + "Qwertyuiop " * 10, "en", "s"))
    return rows


@pytest.mark.parametrize("block", [spelling.BLOCK_WORDS, 3])
@pytest.mark.parametrize("rows", [generated(), chained()], ids=["mixed", "chains"])
def test_spelling(spark, rows, block):
    """With small sub-blocks every large block is cut into many."""
    got = spelling.variants(spark.createDataFrame(rows, SCHEMA).repartition(3), block_words=block)
    want = spelled(rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert any(row[4] for row in want)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcé", min_size=6, max_size=9), min_size=2, max_size=40, unique=True))
def test_gram_pairs_in_all_blocks(words):
    """Every pair one edit apart is found in exactly one block."""
    import pyarrow as pa

    batch = pa.record_batch({"word": words, "n": pa.array(range(len(words)), pa.int64())})
    cells = pa.Table.from_batches(spelling._cells([batch])).sort_by("cell")
    size = cells.num_rows
    cells = cells.append_column("part", pa.array([0] * size)).append_column("sub", pa.array([0] * size))
    cells = cells.append_column("across", pa.array([False] * size))
    got = Counter(
        (r["word"], r["near"]) for b in spelling._links(cells.to_batches(max_chunksize=50)) for r in b.to_pylist()
    )

    def near(a, b):
        swaps = {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "abcé"} - {a}
        drops = {a[:i] + a[i + 1 :] for i in range(len(a))}
        adds = {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "abcé"}
        return b in swaps | drops | adds

    assert got == Counter((a, b) for a in words for b in words if near(a, b))


def searched(rows, benchmark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in benchmark:
        w = word.findall(lower(text))
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    want = Counter()
    for doc_id, text, *_ in rows:
        w = word.findall(lower(text))
        hit, items = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    items |= {str(x) for x in found if x is not None}
        listed = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        want[doc_id, len(w), len(hit), len(items), listed, bool(hit)] += 1
    return want


def passages(seed=1):
    r = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(9)] + ["Été", "中文", "7"]
    draw = lambda n: " ".join(r.choice(vocabulary, n))
    bench = [(i, draw(int(n))) for i, n in enumerate(r.integers(0, 40, 60))]
    bench += [(0, bench[1][1]), (None, draw(12)), (70, None), (71, " .,! "), (72, "w1"), (73, "only here")]
    bench += [(74, "a " * 30), (bench[3][0], bench[3][1])]
    rows = [(i, draw(int(n)), "en", "s") for i, n in enumerate(r.integers(0, 80, 60))]
    for i in range(20):
        cut = (bench[i][1] or "").split()
        rows.append((200 + i, f"{draw(5)} {' '.join(cut[2:]).upper()}, {draw(4)}", "en", "s"))
    rows += [(300, None, "en", "s"), (301, "", "en", "s"), (None, "only HERE; a a a a a a a a a a a", "en", "s")]
    rows += [rows[0], rows[0], (302, "a " * 5000 + draw(50), "en", "s")]
    return rows, bench


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 300])
def test_contamination(spark, block):
    """The benchmark in one broadcast, and in many."""
    rows, bench = passages()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("clash")).repartition(4)
    items = spark.createDataFrame(bench, "item_id long, text string").withColumn("words", F.lit(1))
    got = decontam.contaminated(docs, items, block_bytes=block)
    assert Counter(tuple(r) for r in got.collect()) == searched(rows, bench)


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 300])
def test_contamination_of_long_items(spark, monkeypatch, block):
    """Items cut into several rows, texts into several pieces."""
    monkeypatch.setattr(decontam, "CUT_WORDS", 25)
    rng = np.random.default_rng(3)
    words = [f"v{i}" for i in range(400)]
    item = " ".join(rng.permutation(words))
    rows = [(1, item, "en", "s"), (2, item[500:900], "en", "s"), (3, " ".join(words), "en", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    bench = [(5, item), (6, "absent")]
    got = decontam.contaminated(docs, spark.createDataFrame(bench, "item_id long, text string"), block)
    assert Counter(tuple(r) for r in got.collect()) == searched(rows, bench)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), min_size=1, max_size=6), st.integers(1, 40))
def test_shift_tables_miss_nothing(text, items, size):
    """Small alphabets and text pieces of any length."""
    found = decontam.build([(str(i), min(10, len(w)), " ".join(w).encode()) for i, w in enumerate(items)])
    whole = " ".join(text).encode()
    original = tally.pieces
    try:
        decontam.pieces = lambda data, outside: original(data, outside, size)
        n, spans, got = decontam.search(whole, found)
    finally:
        decontam.pieces = original
    (want,) = searched([(0, " ".join(text))], [(i, " ".join(w)) for i, w in enumerate(items)])
    assert (n, sum(e - s for s, e in spans), len(got)) == want[1:4]


@pytest.mark.parametrize("size", [1, 5, 64])
def test_pieces_keep_words_whole(size):
    text = "  ab çdé\n" + "x" * 200 + " ,, end"
    made = list(tally.pieces(text.encode(), decontam.NOT_WORD, size))
    assert b"".join(made) == text.encode()
    assert [w for p in made for w in decontam.WORD.findall(p)] == decontam.WORD.findall(text.encode())


def test_held_counts_are_handed_on(spark, docs, monkeypatch):
    import pyarrow as pa

    rows = generated()
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": [str(r[0] or "") for r in rows], "text": [r[1] or "" for r in rows],
         "lang": [r[2] or "" for r in rows], "source": [r[3] or "" for r in rows]}
    )
    for module, key in ((divergence, "term"), (spelling, "word")):
        whole = [r for b in module._count([batch]) for r in b.to_pylist()]
        monkeypatch.setattr(module, "HELD_KEYS", 10)
        parts = [r for b in module._count([batch]) for r in b.to_pylist()]
        assert len(parts) > len(whole)
        sums = [Counter(), Counter()]
        for out, rows_ in zip(sums, (whole, parts)):
            for r in rows_:
                out[r.get("lang"), r.get("source"), r[key]] += r["n"]
        assert sums[0] == sums[1]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert divergence.audit(none).count() == 0
    assert spelling.variants(none).count() == 0
    assert decontam.contaminated(none, items).count() == 0
    rows = decontam.contaminated(docs, items).collect()
    assert len(rows) == docs.count() and not any(r.contaminated for r in rows)


@pytest.mark.parametrize("name", ["op11_divergence", "op13_contamination"])
def test_sql_twins(spark, name):
    con = connect(SF)
    assert differences(llm_queries()[name](spark, SF), con, llm_oracles()[name]) == []


def test_spelling_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = llm_queries()["op12_spelling"](spark, SF)
    assert Counter(tuple(r) for r in got.collect()) == spelled(rows)
