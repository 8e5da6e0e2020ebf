"""Every operator against brute force on the smallest tables, and over awkward rows."""

import json
import unicodedata
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vellum.llm import format_duplicates, leakage, mixing, near_duplicates, quality, repetition, scanned, sentences, shared_spans, truncation


def fold(t):
    return "".join(c for c in t.lower() if unicodedata.category(c)[0] in "LN")


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "source").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect() if r.text is not None}


LONG = "The keeper of the long lane counted every lamp twice before the rain. " * 30_000
PLAIN = "A quiet surveyor weighed a bundle of reeds near the mill. " + "".join(f"Then lamp {i} was lit by keeper {i * 7}. " for i in range(12))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, blanks, a very long text, repeated rows, ties, and columns named as the operators name theirs."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, PLAIN), (6, PLAIN), (6, PLAIN), (7, "!" * 60_000), (8, PLAIN.upper()), (9, "x"), (10, "“" * 3000 + "\n" * 50)]
    base = spark.createDataFrame([(i, t, None, i % 2, "q", [1], b"z", t) for i, t in rows], "doc_id long, text string, source string, n int, key string, keys array<int>, sketch binary, h string")
    return base.withColumn("g", F.lit(1)).withColumn("verdict", F.lit("clean")).withColumn("kind", F.lit(3)).withColumn("position", F.lit(0)).withColumn("cut", F.lit(True))


def ids(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# -- 2 ------------------------------------------------------------------------------------------


def brute_repeated(t):
    n = fold(t)
    seen, mark = set(), bytearray(len(n))
    for i in range(len(n) - 29):
        k = n[i : i + 30]
        if k in seen:
            mark[i : i + 30] = b"\1" * 30
        seen.add(k)
    return len(n), sum(mark)


def test_repetition_equals_brute_force(docs, texts):
    want = sorted(i for i, t in texts.items() if (c := brute_repeated(t))[0] and c[1] >= 0.3 * c[0])
    assert [r.doc_id for r in repetition.repeating(docs).orderBy("doc_id").collect()] == want
    got = {r.doc_id: (r.folded_chars, r.repeated_chars) for r in repetition.exact_shares(docs).collect()}
    assert got == {i: brute_repeated(t) for i, t in texts.items()}


def test_decision_list_learns_and_emits(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((600, len(repetition.FEATURES)))
    y = x[:, 1] > 0.7
    rules = repetition.learn(x, y)
    said = rules.predict(x)
    assert not y[said == "clean"].any() and y[said == "repeating"].all() and (said == "clean").sum() > 50
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(repetition.FEATURES))
    assert [r.v for r in df.select(rules.column().alias("v")).collect()] == list(said)
    assert str(repetition.learn(x[:10], y[:10])) == "else unsure"


def test_short_loops_are_not_let_go(spark):
    """Loops of few different runs; a list that calls everything clean must not lose them."""
    import random

    r = random.Random(5)
    prose = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(prose)]
    for k in range(40):
        loop = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1 + k % 12))
        rows.append((100 + k, prose[k] + (loop * 300)[:300]))
    want = sorted(i for i, t in rows if (c := brute_repeated(t))[1] >= 0.3 * c[0])
    assert want == list(range(100, 140))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for rules in (None, repetition.DecisionList([([], "clean")], "unsure"), repetition.DecisionList([([(1, "<=", 0.06)], "clean")], "unsure")):
        assert [i for (i,) in ids(repetition.repeating(df, rules), "doc_id")] == want
    said = {r.doc_id: r.verdict for r in repetition.judged(df, repetition.DecisionList([([], "clean")], "unsure")).collect()}
    assert all((said[i] == "unsure") == (i >= 100) for i in said)


def test_the_list_decides_most_documents_both_ways(spark, data):
    """Learned on whole tables, it settles more than half of the rows, and rightly."""
    docs = spark.read.parquet(data.rstrip("/").rsplit("/", 1)[0] + "/sf0.01/documents.parquet")
    said = repetition.judged(docs).join(repetition.exact_shares(docs), "doc_id")
    true = (F.col("folded_chars") > 0) & (F.col("repeated_chars") >= repetition.SHARE * F.col("folded_chars"))
    n = {(r.verdict, r.y): r["count"] for r in said.groupBy("verdict", true.alias("y")).count().collect()}
    assert n.get(("clean", True), 0) == n.get(("repeating", False), 0) == 0
    assert n["clean", False] > 0.5 * sum(n.values()) and n["repeating", True] > 0.5 * (n["repeating", True] + n.get(("unsure", True), 0))


# -- 4 ------------------------------------------------------------------------------------------


def brute_stretches(texts):
    where = defaultdict(set)
    for i, t in texts.items():
        for p in range(len(t) - 199):
            where[t[p : p + 200]].add(i)
    out = set()
    for i, t in texts.items():
        spans = []
        for p in range(len(t) - 199):
            if len(where[t[p : p + 200]]) > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + 200
                else:
                    spans.append([p, p + 200])
        out |= {(i, a, b) for a, b in spans}
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_shared_spans_equal_brute_force(docs, texts, hot):
    got = {tuple(r) for r in shared_spans.stretches(docs, hot=hot).collect()}
    assert got == brute_stretches(texts) and got


def test_shared_spans_equal_brute_force_on_more_rows(spark, data):
    """Enough rows that documents share windows but not the anchors at their edges."""
    wider = data.rstrip("/").rsplit("/", 1)[0] + "/sf0.01"
    docs = spark.read.parquet(f"{wider}/documents.parquet").select("doc_id", "text")
    held = {r.doc_id: r.text for r in docs.where("text is not null").collect()}
    assert {tuple(r) for r in shared_spans.stretches(docs).collect()} == brute_stretches(held)


def test_windows_whose_edges_differ_find_each_other(spark):
    """Many documents cut one base at random places: partners hold a window under other edge anchors."""
    import random

    r = random.Random(11)
    base = " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(500))
    mixed = {}
    for i in range(60):
        a = r.randrange(len(base) - 500)
        b = a + r.randrange(180, 480)
        mixed[i] = "".join(r.choice("klmnop ") for _ in range(r.randrange(60))) + base[a:b] + "".join(r.choice("klmnop ") for _ in range(r.randrange(60)))
    df = spark.createDataFrame(list(mixed.items()), "doc_id long, text string")
    assert {tuple(x) for x in shared_spans.stretches(df).collect()} == brute_stretches(mixed)


def test_shared_span_with_three_partners(spark):
    import random

    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(400)]
    base = " ".join(words)
    mixed = {1: base[:900], 2: "zz " + base[100:600] + " yy", 3: base[450:1200] + " q", 4: base[300:501] + "." + base[520:800], 5: " ".join(reversed(words))[:900]}
    df = spark.createDataFrame(list(mixed.items()), "doc_id long, text string")
    for hot in (20_000, 1):
        assert {tuple(x) for x in shared_spans.stretches(df, hot=hot).collect()} == brute_stretches(mixed)


# -- 5 ------------------------------------------------------------------------------------------


def brute_groups(texts):
    runs = {i: {n[p : p + 24] for p in range(len(n) - 23)} for i, t in texts.items() if len(n := fold(t)) >= 24}
    parent = {i: i for i in runs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(runs)
    for k, a in enumerate(keys):
        for b in keys[k + 1 :]:
            common = len(runs[a] & runs[b])
            if 2 * common >= len(runs[a]) + len(runs[b]) - common:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(find(i), i) for i in runs if find(i) != i}


def test_groups_equal_brute_force(docs, texts):
    assert {tuple(r) for r in near_duplicates.members(docs).collect()} == brute_groups(texts)


def test_hot_bucket_is_cut_into_blocks(spark, monkeypatch):
    import random

    r = random.Random(1)
    base = "".join(r.choice("abcdefghijklmnop ") for _ in range(1500))
    rows = {}
    for i in range(130):
        t = list(base)
        for _ in range(3):
            t[r.randrange(len(t))] = r.choice("xyz")
        rows[i] = "".join(t)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for tile in (4096, 40):
        monkeypatch.setattr(near_duplicates, "TILE", tile)
        assert {tuple(x) for x in near_duplicates.members(df).collect()} == {(0, i) for i in range(1, 130)}


def test_bit_sliced_distances():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (500, 64), dtype=np.uint8)
    b = np.where(rng.random((500, 64)) < 0.3, rng.integers(0, 256, (500, 64), dtype=np.uint8), a)
    b[::3] = rng.integers(0, 256, (167, 64), dtype=np.uint8)
    lanes, dist = near_duplicates.distances(a, b, near_duplicates.RADIUS)
    want = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    assert set(lanes) == set(np.flatnonzero(want <= near_duplicates.RADIUS)) and (dist == want[lanes]).all()


# -- 6 ------------------------------------------------------------------------------------------


def test_copies_equal_brute_force(spark, docs, texts, data):
    records = spark.read.parquet(f"{data}/records.parquet")
    groups = defaultdict(list)
    for i, t in texts.items():
        if fold(t):
            groups["documents", fold(t)].append(i)
    for r in records.collect():
        p = format_duplicates.parse_record(r.raw)
        if p:
            groups["records", tuple(map(fold, p))].append(r.record_id)
    want = {(k[0], min(v), i) for k, v in groups.items() for i in v if i != min(v)}
    entries = format_duplicates.document_entries(docs).unionByName(format_duplicates.record_entries(records))
    for size in (24 << 20, 2000):
        assert {tuple(r) for r in format_duplicates.copies(entries, size).collect()} == want
    counts = {(r.in_table, r.first_id): r.n_copies for r in format_duplicates.contents(entries, 2000).collect()}
    assert counts == {(k[0], min(v)): len(v) for k, v in groups.items()}


def test_redelivered_row_counts_once_across_partitions(spark):
    rows = [(1, "A b c."), (2, "a B c"), (1, "A b c."), (3, "other"), (4, "x" * 5000), (5, "x" * 5000 + "y"), (5, "x" * 5000 + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for size in (24 << 20, 100):
        got = {(r.first_id, r.n_copies) for r in format_duplicates.contents(format_duplicates.document_entries(df), size).collect()}
        assert got == {(1, 2), (3, 1), (4, 1), (5, 1)}
        assert ids(format_duplicates.copies(format_duplicates.document_entries(df), size), "first_id", "copy_id") == [(1, 2)]


def test_trie_counts_prefixes_apart():
    t = format_duplicates.Trie()
    data = [b"a", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefghabcdefgh", b"abcdefgh", b"a"]
    seen = [t.add(x) for x in data]
    assert [new for _, new in seen] == [True] * 5 + [False] * 2 and seen[5][0] == seen[2][0] and seen[6][0] == seen[0][0]


def test_records_that_do_not_count():
    p = format_duplicates.parse_record
    assert p(None) is None and p("[1]") is None and p('{"text": 5}') is None and p('{"text": " "}') is None and p("{") is None and p('{"text": NaN}') is None
    assert p('{"text":"a","year":1900.50,"title":null}') == ("a", "", "", "1900.50") == p('{"year":"1900.50","text":"a"}')


# -- 8 ------------------------------------------------------------------------------------------


def test_leaks_equal_brute_force(spark, docs, texts, data):
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    folded = {i: fold(t) for i, t in texts.items()}
    want = set()
    for r in bench.collect():
        n = fold(r.text)
        for i, t in folded.items():
            if any(n[p : p + 40] in t for p in range(len(n) - 39)):
                want.add((r.item_id, i))
    assert {tuple(x) for x in leakage.leaked(docs, bench).collect()} == want


def test_leak_with_substitutions(spark):
    item = "Which lantern did the harbour pilot lower into the flooded quarry before the autumn fair"
    changed = item.replace("harbour", "harbxur")
    d = spark.createDataFrame([(1, "Before. " + changed + ". After."), (2, "nothing of the kind is here at all, only lanterns and pilots")], "doc_id long, text string")
    b = spark.createDataFrame([(7, item, None)], "item_id long, text string, task string")
    got = leakage.leak_report(d, b).collect()
    assert [(r.item_id, r.doc_id, r.substitutions) for r in got] == [(7, 1, 1)] and got[0].length >= 70


def test_long_leak_is_reported_whole(spark):
    import random

    r = random.Random(9)
    item = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(700))
    changed = item[:300] + "0" + item[301:500] + "1" + item[501:]
    d = spark.createDataFrame([(1, "Before 77. " + item), (2, changed + " 88 after"), (3, item[:250]), (4, item[200:600])], "doc_id long, text string")
    b = spark.createDataFrame([(7, item, None)], "item_id long, text string, task string")
    got = {x.doc_id: (x.length, x.substitutions, x.exact_run, x.item_share) for x in leakage.leak_report(d, b).collect()}
    assert got == {1: (700, 0, 700, 1.0), 2: (700, 2, 300, 1.0), 3: (250, 0, 250, 0.3571), 4: (400, 0, 400, 0.5714)}


# -- 9 ------------------------------------------------------------------------------------------


def test_mixture_meets_budgets(spark):
    rows = [(i, "big" if i % 3 else "Small ", 10 + i % 7) for i in range(300)]
    d = spark.createDataFrame([(*r, None) for r in rows] + [(900, None, 5, None)], "doc_id long, source string, size long, text string")
    t = spark.createDataFrame([("big", 0.5, 2), ("small", 0.4, 3), ("gone", 0.1, 1)], "source string, target_share double, max_repeats int")
    items = mixing.sized(d, F.col("size"))
    plan = {r.source: r for r in mixing.plan(items, t).collect()}
    total = sum(r[2] for r in rows)
    assert plan["big"].total == total and not plan["gone"].reachable and plan["small"].reachable
    used = defaultdict(int)
    for r in mixing.mixture(items, t).collect():
        assert 1 <= r.uses <= plan[r.source].max_repeats
        used[r.source] += r.uses * r.size
    for s in ("big", "small"):
        assert plan[s].budget - 17 < used[s] <= plan[s].budget
    assert [r.source for r in mixing.unreachable(items, t).collect()] == ["gone"]
    assert sum(r.share_reached for r in mixing.shares(items, t).collect()) == pytest.approx(1)


# -- 1, 3, 7, 10: judgement ---------------------------------------------------------------------

PAGES = "\n".join(
    f"The Salt Road of Marwick\nThe toll collector of the {w} town counted all the lamps and\nlent a copper kettle before the long drought came to an end.\nNobody in the parish remem-\nbered it, though the keeper wrote a line about it in a book.\n[{41 + k}]\n---"
    for k, w in enumerate(("northern", "southern", "eastern", "western"))
)


def test_scanned_pages():
    known = scanned.Vocabulary({"remembered": 50, "counted": 80}, {})
    found, text = scanned.examine(PAGES, known)
    kinds = defaultdict(set)
    for n, k in found:
        kinds[k].add(n)
    assert kinds["header"] == {1, 8, 15, 22} and kinds["page_number"] == {6, 13, 20, 27} and kinds["hyphen"] == {4, 11, 18, 25}
    assert "remembered it" in text and "[41]" not in text and "Salt Road" not in text
    assert scanned.examine("One line.\nAnother line.", known) is None


def test_misread_words():
    known = scanned.Vocabulary({"harvest": 900, "well-known": 40, "wellknown": 0, "money": 500}, {})
    assert scanned.misread("harvcst", known) == "harvest" and scanned.misread("m0ney", known) == "money" and scanned.misread("harvest", known) is None
    assert scanned.misread("14th", known) is None and scanned.own_hyphen("well", "known", known) and not scanned.own_hyphen("har", "vest", known)


def test_misread_names_by_shares_of_different_texts(spark):
    def grams(word, n):
        return dict.fromkeys(scanned._grams(word.lower()), n)

    for by in (1, 10, 1000):
        known = scanned.Vocabulary({"wortcrbuch": 3 * by, "the": 9000 * by}, {**grams("Worterbuch", 200 * by), "rtc": 3 * by, "tcr": 3 * by, "crb": 3 * by}, texts=10_000 * by)
        assert scanned.misread("Wortcrbuch", known) == "Worterbuch"
        known = scanned.Vocabulary({"the": 9000 * by}, {**grams("Worterbuch", 39 * by)}, texts=10_000 * by)
        assert scanned.misread("Wortcrbuch", known) is None  # the repair is rare too
        known = scanned.Vocabulary({"the": 9000 * by}, {**grams("Worterbuch", 9000 * by), "rtc": 41 * by, "tcr": 41 * by, "crb": 41 * by}, texts=10_000 * by)
        assert scanned.misread("Wortcrbuch", known) is None  # its letters are usual
    rows = [(i, t) for i, t in enumerate(["Wortcrbuch stands here."] * 5 + ["WORTCRBUCH, stands here!", "The mill stands.", "A mill, a Wortcrbuch.", None])]
    known = scanned.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"))
    assert known.texts == 3 and known.count("Wortcrbuch") == 2 and known.grams["rtc"] == 2 and known.count("stands") == 2 and known.count("here") == 0


CASES = {
    "Mr. Ott met Dr. Ens at 6 p.m. near St. Ann. He waited ... and then left. It cost 3.5 crowns.": 3,
    "“It is late. Let us go,” said Ott, and left. “Stop!” a man cried.": 2,
    "Man kaufte z. B. Tau usw. am 3. März. Er ging.": 2,
    "彼は「もう遅い。帰ろう。」と言って去った。待っていた……すると来た。": 2,
    "डॉ. राम आया। वह गया।": 2,
    "Chapter 4\n\nThe first\nline goes on. The end": 3,
    "คนเฝ้าสวนนับไหน้ำมัน เชือกยาว 18.47 เมตร": 2,
}


def test_sentences_keep_positions(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = defaultdict(list)
    for r in sentences.split_sentences(df).orderBy("doc_id", "position").collect():
        got[r.doc_id].append(r)
    for i, (text, n) in enumerate(CASES.items()):
        assert len(got[i]) == n, (text, [u.unit for u in got[i]])
        for u in got[i]:
            assert text[: u.end_pos].endswith(u.unit)


def test_long_quotation_is_one_unit(spark):
    """Quotations of many lines, without a bound; an open one ends at its paragraph."""
    speech = "“" + "It is late. The mill\nstands. A fair\n" * 150 + "goes on,” said Ott, and left."
    rows = [(1, speech + " He slept."), (2, speech + " He slept. He woke."), (3, "“" + "It\n" * 30_000 + "is,” said Ott. He slept."), (4, "“Open. It goes\non.\n\nHe slept.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r["count"] for r in sentences.split_sentences(df).groupBy("doc_id").count().collect()}
    assert got == {1: 2, 2: 3, 3: 2, 4: 3}


def test_kinds(spark):
    prose = "The miller sold the mill. Nobody bought it, and the harvest was late. " * 4
    table_ = "\n".join(f"name{k} | {k * 13} | {k * 7}" for k in range(8))
    list_ = "Things\n" + "\n".join(f"• item {k} from the mill" for k in range(8))
    junk = "\n".join("#~{}[" * 12 for _ in range(5))
    df = spark.createDataFrame([(1, prose), (2, table_), (3, list_), (4, junk), (5, " "), (6, None)], "doc_id long, text string")
    assert ids(quality.not_prose(df), "doc_id", "kind") == [(2, "table"), (3, "list"), (4, "junk")]


def test_truncation(spark):
    body = "The miller sold the mill in May. Nobody bought it before the fair. "
    rows = [(i, (body * 20)[: 700 + 13 * i % 400] if i % 4 == 0 else body * (3 + i % 9) + "The end came.", "a") for i in range(60)]
    rows += [(100 + i, (f"Keeper {i} lit a lamp. " + body * 30)[:1000], "b") for i in range(40)]
    rows += [(200, body + "\n\nTHE END", "b"), (201, None, "b"), (202, body + "\n\n— Anna Ott", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = {r.doc_id for r in truncation.truncated(df).collect()}
    for i, t, _ in rows:
        if i < 200:
            assert (i in cut) == (t.rstrip()[-1] not in ".!?"), (i, t[-30:])
    assert not cut & {200, 201, 202}
    assert {(r.source, r.unit, r.length) for r in truncation.limits(truncation.endings(df)).collect()} >= {("b", "chars", 1000)}


def test_cut_copies_teach_no_closing_line(spark):
    body = "The miller sold the mill in May. Nobody bought it before the fair. "
    wrapped = body + "\nA carter then drove the grey mare over the bridge and\nleft the wagon by the gate as quickly as the"
    after = body + "\nAt noon the carter left the wagon by the"
    rows = [(i, (wrapped if i % 2 else wrapped.upper().lower().capitalize())) for i in range(30)] + [(100 + i, after) for i in range(30)]
    rows += [(200 + i, f"Keeper {i} lit lamp {i}. " + body + "\nThen he drove the mare over the bridge and\nsaw that the lamp was lit by the") for i in range(5)]
    rows += [(300 + i, f"Clerk {i} wrote a letter. " + body + f"\nprinted for the Reading Society of Town{chr(65 + i)}") for i in range(5)]
    df = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, source string")
    assert [r.pattern for r in truncation.closers(truncation.endings(df)).collect()] == ["printed for the X X of X"]
    assert [i for (i,) in ids(truncation.truncated(df), "doc_id")] == [i for i, _ in rows if i < 300]


# -- awkward rows and empty tables ------------------------------------------------------------------


def operators(d, bench, targets, records, sample):
    yield scanned.noisy_lines(d)
    yield repetition.repeating(d)
    yield repetition.judged(d)
    yield sentences.sample_ends(d, sample)
    yield shared_spans.stretches(d)
    yield shared_spans.coverage(d)
    yield near_duplicates.members(d)
    entries = format_duplicates.document_entries(d).unionByName(format_duplicates.record_entries(records))
    yield format_duplicates.copies(entries)
    yield format_duplicates.contents(entries)
    yield quality.not_prose(d)
    yield leakage.leaked(d, bench)
    yield leakage.leak_report(d, bench)
    yield mixing.unreachable(mixing.sized(d, F.length("text")), targets)
    yield mixing.shares(mixing.sized(d, F.length("text")), targets)
    yield truncation.truncated(d)
    yield truncation.rates(d)


@pytest.fixture(scope="module")
def others(spark):
    bench = spark.createDataFrame([(1, None, None), (2, "", "t"), (3, PLAIN[:100], "t"), (3, PLAIN[:100], "t")], "item_id long, text string, task string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", None, None)], "source string, target_share double, max_repeats int")
    raws = [(1, None), (2, ""), (3, "{"), (4, json.dumps({"text": "A b"})), (5, json.dumps({"text": "a B!"})), (5, json.dumps({"text": "a B!"}))]
    records = spark.createDataFrame([(*r, "x") for r in raws], "record_id long, raw string, canon string")
    return bench, targets, records, spark.createDataFrame([(5, 1), (5, 2), (None, 3), (77, 1)], "doc_id long, drawn_on int")


def test_awkward_rows(awkward, others):
    got = [ids(df, *df.columns) for df in operators(awkward, *others)]
    assert got[1] == [(4,), (7,)] or got[1] == [(4,)]
    assert {r[0] for r in got[3]} == {5}
    assert got[6] == [(5, 6), (5, 8)]
    assert ("documents", 5, 6) in got[7] and ("records", 4, 5) in got[7]
    assert (3, 5) in got[10] and (3, 8) in got[10]


def test_empty_tables(awkward, others):
    none = [x.limit(0) for x in others]
    for df in operators(awkward.limit(0), *none):
        assert df.count() == 0


def test_page_numbers_come_in_sequence():
    assert [scanned.page_value(x) for x in ("12", "l2", "xiv", "S0", "iv", "|")] == [12, 12, 14, 50, 4, 1]
    values = [3, 4, 9, 5, 6, 6, 7]
    assert [values[k] for k in scanned.rising(values)] == [3, 4, 5, 6, 7] and scanned.rising([]) == [] and len(scanned.rising([5, 5, 4])) == 1
    body = ["The keeper of the long lane counted every lamp and wrote the sum", "into his ledger before the frost came down on the northern mill,", "and nobody in the house by the river asked him for his reasons."]

    def numbers(values):
        lines = [x for v in values for x in (*body, v)]
        return {lines[i] for i, role in enumerate(scanned.Pages("\n".join(lines + body)).roles) if role == "page_number"}

    assert numbers(["21", "22", "2E", "23", "24"]) == {"21", "22", "23", "24"}
    assert numbers(["21", "22", "79", "23", "24"]) == {"21", "22", "79", "23", "24"}  # misread in its sequence
    assert numbers(["7", "7", "7", "7"]) == set() == numbers(["9", "8", "7", "6"])


def test_why_a_text_is_cut(spark):
    whole = "The frost came early. Nobody lit the lamps. "
    rows = [(1, whole + "Then the keeper went", "a"), (2, whole + "Then the keeper went,", "a"), (3, whole.strip(), "a"), (4, None, "a"), (5, " ", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.reason, r.cut) for r in truncation.judged(df).collect()}
    assert got == {1: ("transfer", True), 2: ("broken", True), 3: (None, False)}
