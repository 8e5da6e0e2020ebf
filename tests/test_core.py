"""The core against DuckDB, against plain models, and its own invariants."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from vellum.functions import text as X
from vellum.functions.tokens import load_encoding, with_tokens
from vellum.operators import decontaminate, dedup, filters, formatters, inference, kernels, repair, routing, token_files
from vellum.operators.components import connected_components
from vellum.plans import catalog, folder, run_steps
from vellum import sources


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{data}/{f}')")
    return con


def plain(rows):
    def one(v):
        if isinstance(v, float):
            return None if v != v else round(v, 6)
        return v if v is None or isinstance(v, (int, str, bool)) else str(v).replace("T", " ").replace("+00:00", "")

    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, data, duck, name):
    df = catalog.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = plain(tuple(r[c] for c in cols) for r in df.collect())
    rel = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == plain(tuple(r[i] for i in order) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, data, name):
    catalog.QUERIES[name](spark, data).collect()


def test_text_functions_equal_the_kernels(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("text is not null")
    for r in docs.select("text", X.words(F.col("text")).alias("w"), X.sentences(F.col("text")).alias("s")).collect():
        assert r.w == kernels.word_list(r.text)
        assert r.s == kernels.sentence_list(r.text)


def test_simplify(spark):
    df = spark.createDataFrame([("Élan 3,5 — «naïve»\n\tÀ  la 12 fin!",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.simplify(F.col("t"))).collect()] == ["elan 0 naive a la 0 fin", "", None]


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello old world"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in with_tokens(df, ids="ids", eos=9).collect()}
    encode = load_encoding("/opt/tokenizers/byte_bpe_50k.tiktoken")
    assert got[1].ids == [*encode("Hello old world"), 9] and got[2].token_count == 1 and got[3].ids is None


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 3), (None, 7), *((i, i + 1) for i in range(20, 60))]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(7)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 9, **{i: 20 for i in range(20, 61)}}
    assert connected_components(df.limit(0)).count() == 0


def test_gram_scans():
    w = "a b c a b c a b c".split()
    assert filters.top_gram_chars(w, 2) == 9 and filters.repeated_gram_chars(w, 3) == 6 and filters.top_gram_chars([], 2) == 0


def test_dedup_is_independent_of_partitions(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("text is not null").select("doc_id", "text")
    seen = set()
    for n in (1, 3, 8):
        seen.add(tuple(sorted(r.doc_id for r in dedup.exact_dedup(docs.repartition(n), F.col("text")).collect())))
    assert len(seen) == 1
    once = dedup.exact_dedup(docs, F.col("text")).select("doc_id", "text")
    assert dedup.exact_dedup(once, F.col("text")).count() == once.count()


def test_minhash_groups_edits(spark):
    def word(i: int) -> str:  # letters only: numbers are made alike before shingling
        return "".join(chr(97 + (i // 17**k) % 17) for k in range(3))

    base = " ".join(word(i) for i in range(300))
    rows = [(1, base), (2, base.replace(word(5), "other")), (3, " ".join("z" + word(i) for i in range(300))), (4, "too short"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").where("text is not null")
    clusters = dedup.minhash_clusters(dedup.minhash_signatures(df))
    assert {(r.doc_id, r.minhash_cluster_id, r.minhash_cluster_size) for r in clusters.collect()} == {(1, 1, 2), (2, 1, 2)}
    assert {r.doc_id: r.minhash_cluster_size for r in dedup.minhash_dedup(df, clusters).collect()} == {1: 2, 3: 1, 4: 1}


def test_sentence_dedup_removes_covered_sentences():
    text = "One came. Two went. Three sat. Four ran."
    assert dedup.remove_sentences(text, [1], 2) == "One came. Four ran."
    assert dedup.remove_sentences(text, [1], 2, min_words_span=5) == "One came. Two went. Four ran."


def test_decontamination_finds_the_first_gram(spark):
    item = " ".join(f"w{i}" for i in range(20))
    d = spark.createDataFrame([(1, "before it " + item), (2, "nothing here")], "doc_id long, text string")
    b = spark.createDataFrame([(1, item, "t")], "item_id long, text string, task string")
    r = decontaminate.contaminated(d, decontaminate.ngram_index(b)).collect()
    assert len(r) == 1 and r[0].contaminated_task == "t" and len(r[0].contaminated_ngram.split()) == 12


def test_formatters(spark):
    df = spark.createDataFrame([("mail a.b@x.org or c@y.de from 8.8.8.8 and 10.0.0.1",)], "t string")
    got = df.select(formatters.mask_pii(F.col("t"))).first()[0]
    assert got == "mail email@example.com or firstname.lastname@example.org from 22.214.171.124 and 10.0.0.1"
    page = '<html><head><title>t</title></head><body><nav>menu</nav><div class="ad">buy</div><p>One &amp; two<br>three</p><script>x</script><p>four</body>'
    assert formatters.extract(page) == "One & two\nthree\n\nfour"
    lines = spark.createDataFrame([("a\n***\n--- !\n\nb",)], "t string")
    assert lines.select(formatters.drop_symbol_lines(F.col("t"))).first()[0] == "a\n\nb"
    assert lines.select(formatters.drop_symbol_lines(F.col("t"), replacement="#")).first()[0] == "a\n#\n\nb"
    bad = spark.createDataFrame([("cafÃ© &amp; bar\x1b[0m",)], "t string")
    assert bad.select(formatters.fix_encoding(F.col("t"))).first()[0] == "café & bar"


HEAD, FOOT = "Letters from the northern mill house", "Printed for the lending library at Ott"


def test_page_repair():
    body = ["the keeper counted every lamp along the towpath and then"] + [f"went on with the work of week {w} in the mill." for w in ("one", "two", "three", "four", "five")]
    pages = [f"{HEAD.replace('mill', 'rnill') if k == 2 else HEAD}\n{k + 21}\n{b}\n{FOOT}" for k, b in enumerate(body)]
    text, counts = repair.repair_pages("\n---\n".join(pages))
    assert counts == {"pages_detected": 6, "page_boundaries_detected": 5, "headers_removed": 6, "footers_removed": 6, "page_numbers_removed": 6, "boundary_joins": 1}
    assert all(b in text for b in body) and "---" not in text
    assert repair.repair_pages("no pages here") == ("no pages here", {"pages_detected": 1, "page_boundaries_detected": 0})


def paged(head, numbers, foot="", left="the miller wrote each sack of grain into the ledger by"):
    bodies = [f"{left} candle {w}." for w in "one two three four five six seven eight nine ten".split()]
    return [f"{head(k)}\n{b}{foot}\n{n}" if n else f"{head(k)}\n{b}{foot}" for k, (b, n) in enumerate(zip(bodies, numbers))]


def test_page_repair_rules():
    """One case for each rule of the page repair."""
    same = lambda k: HEAD
    # heads whose numbers have one digit or two are one line; but numbers in a head have to be the same
    assert repair.furniture_signature("Chapter 9_b, page 9") == "chapter 0_b page 0" == repair.furniture_signature("CHAPTER 12_b; page 103")
    text, n = repair.repair_pages("\f".join(paged(lambda k: f"Reports of the year 18{k + 10} to the board", [""] * 5)))
    assert n["headers_removed"] == 0
    text, n = repair.repair_pages("\f".join(paged(lambda k: "Reports of the year 1812 to the board", [""] * 5)))
    assert n["headers_removed"] == 5 and n.evidence == 5 and abs(n.weight - 5.0) < 1e-9
    # evidence grows with the share of pages
    pages = paged(same, [""] * 10)
    pages[7:] = [p.split("\n", 1)[1] for p in pages[7:]]
    text, n = repair.repair_pages("\f".join(pages))
    assert n["headers_removed"] == 7 and abs(n.weight - 7 * 0.85) < 1e-9
    # numbers with a learned title before them
    text, n = repair.repair_pages("\f".join(paged(lambda k: f"The Mill House .... {k + 40}", [""] * 6)))
    assert n["page_numbers_removed"] == 6 and abs(n.weight - 6 * 0.95) < 1e-9 and "Mill House" not in text
    # a number out of its sequence stays
    text, n = repair.repair_pages("\f".join(paged(lambda k: f"{k + 10 if k != 3 else 77}", [""] * 6)))
    assert n["page_numbers_removed"] == 5 and "77" in text
    # a run of leading numbers at another distance
    text, n = repair.repair_pages("\f".join(paged(lambda k: f"{k + 10 if k < 6 else k + 11}", [""] * 10)))
    assert n["page_numbers_removed"] == 10
    # a foot pasted behind an ellipsis
    pages = paged(lambda k: f"({k})", [FOOT] * 6)
    pages[2] = f"(2)\nthe lamp went out ... {FOOT}"
    text, n = repair.repair_pages("\f".join(pages))
    assert n["footers_removed"] == 6 and "the lamp went out\n" in text + "\n" and abs(n.weight - (5 * (0.5 + 0.5 * 5 / 6) + 0.75 + 0.25 * 5 / 6)) < 1e-9
    # a sentence over a break
    text, n = repair.repair_pages("The keeper of the lane went slowly down to\n---\nthe river.\n---\nNext day.")
    assert text == "The keeper of the lane went slowly down to the river.\n\nNext day." and (n["boundary_joins"], n.weight, n.evidence) == (1, 0.9, 1)
    for wrong in ({"markers": ()}, {"window": 0}, {"pages": 1}, {"fraction": 0}):
        with pytest.raises(ValueError):
            repair.PageRules(**wrong)


def test_span_and_loop_rules():
    """One case for each rule of the span and the loop repair."""
    para = "The toll collector of the northern town counted all the lamps along the towpath twice, and wrote each of them into his small ledger before supper."
    # blanks do not count, the window does, paragraphs are put together anew
    spaced = para.replace(" ", "  ")
    assert repair.repair_spans(f"{para}\n \n\n{spaced}\n\nend")[0] == f"{para}\n\nend"
    far = "\n\n".join([para, *[f"short {k}" for k in range(6)], para])
    assert repair.repair_spans(far)[1]["duplicate_blocks_removed"] == 0
    # spans of lines: longest first, compared without regard to blanks, against lines that are still there
    lines = [f"line number {w} of the long inventory of the northern mill house by the river" for w in "one two three four five".split()]
    text, n = repair.repair_spans("\n".join([*lines, "between", *(x.replace(" ", "   ", 2) for x in lines), "after"]))
    assert n["duplicate_blocks_removed"] == 1 and text == "\n".join([*lines, "between", "after"])
    # loops keep their spacing
    loop = "start  here " + "the same long\tphrase of several  words again " * 40 + "end"
    text, n = repair.repair_loops(loop)
    assert text == "start  here the same long\tphrase of several  words again end" and (n["long_line_loops_removed"], n.evidence, n.weight) == (1, 1, 0.98)
    assert n["loop_chars_removed"] == len(loop) - len(text)
    assert repair.repair_loops("the same few words again " * 30)[1]["long_line_loops_removed"] == 0  # 750 characters


def test_gram_scans_equal_the_plain_scan():
    import random

    def scan(words, n):
        met, total, at = set(), 0, 0
        while at + n <= len(words):
            g = tuple(words[at : at + n])
            if g in met:
                total, at = total + sum(map(len, g)), at + n
            else:
                met.add(g)
                at += 1
        return total

    r = random.Random(0)
    for _ in range(500):
        w = [r.choice(["aa", "b", "cc", "ddd"][: r.randint(1, 4)]) for _ in range(r.randint(0, 40))]
        grams = filters.Grams(w)
        assert [filters.repeated_gram_chars(grams, n) for n in range(2, 7)] == [scan(w, n) for n in range(2, 7)]


def test_local_repairs(spark):
    para = "The toll collector of the northern town counted all the lamps along the towpath twice, and wrote each of them into his small ledger before supper."
    text, n = repair.repair_spans(f"{para}\n\nshort\n\n{para}\n\nshort")
    assert n == {"duplicate_blocks_removed": 1} and text.count("toll") == 1 and text.count("short") == 2
    loop = "start " + "the same long phrase of several words again " * 30 + "end of it all " + "x" * 10
    text, n = repair.repair_loops(loop)
    assert n["long_line_loops_removed"] == 1 and n["loop_chars_removed"] > 1000 and text.startswith("start the same")
    raw = "ﬁne ﬂow­\ner so­ft  \n\n\n\n\nend \x07"
    df = repair.repair_book(spark.createDataFrame([(1, raw), (2, "")], "doc_id long, text string"))
    r = {x.doc_id: x for x in df.collect()}
    assert r[1].text == "fine flower soft\n\nend" and r[1].repair.ligatures_normalized == 2 and r[1].repair.soft_hyphens_removed == 2
    assert r[1].repair.soft_hyphen_line_joins == 1 and r[1].repair.blank_lines_collapsed == 2 and r[2].repair.chars_after == 0


def test_url_filter(spark):
    urls = ["http://a.bad.com/x", "https://sub.ok.org/", "http://z.org/buy-now", "http://z.org/a-soft-word-mild", "http://z.org/XspamX", "http://fine.net/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    reason = filters.url_filter(F.col("u"), domains=["bad.com", "sub.ok.org"], banned=["buy"], soft=["soft", "mild"], sub=["spam"])
    assert [r[0] for r in df.select(reason).collect()] == ["domain", "subdomain", "hard_blacklisted", "soft_blacklisted", "blacklisted_subword", None]


def test_routing_rules(spark):
    df = spark.createDataFrame([("exact_dedup", "x", "y"), ("gate", "x", "y"), ("gate", "x", None)], "stage string, new string, old string")
    assert [r[0] for r in df.select(routing.final_reason(F.col("stage"), F.col("new"), F.col("old"))).collect()] == ["x", "y", "x"]


def test_inference_resumes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, text string")
    first = inference.rollouts(df.where("doc_id = 1"), count=2)
    assert [r.n_rollouts for r in first.collect()] == [2]
    assert [r.doc_id for r in inference.rollouts(df, done=first).collect()] == [2]


def test_token_files(spark, tmp_path):
    path = str(tmp_path / "a.ds")
    token_files.write_token_file(path, iter([[1, 2, 9], [3, 9], [4, 5, 6, 9]]))
    assert [list(map(int, x)) for x in token_files.read_token_file(path)] == [[1, 2, 9], [3, 9], [4, 5, 6, 9]]
    assert token_files.check_token_file(path, 9) and not token_files.check_token_file(path, 8)
    token_files.write_indexed_file(str(tmp_path / "b"), iter([[1, 2], [3]]))
    assert (tmp_path / "b.idx").read_bytes()[:9] == b"MMIDIDX\x00\x00" and (tmp_path / "b.bin").stat().st_size == 6
    rows = sources.read_tokens(spark, path, 4).collect()
    assert [r.tokens for r in rows] == [[1, 2, 9, 3], [9, 4, 5, 6]]
    df = spark.createDataFrame([(i, [i, i + 1, 0]) for i in range(10)], "doc_id long, tokens array<int>").repartition(3)
    done = token_files.write_partitions(df, str(tmp_path / "parts")).collect()
    assert sum(r.documents for r in done) == 10 and sum(r.tokens for r in done) == 30


def test_file_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": "1", "text": "x"}\nbroken\n{"id": "2", "text": "y"}\n')
    assert {r.id for r in sources.read_jsonl(spark, str(tmp_path / "in"), "id string, text string").where("id is not null").collect()} == {"1", "2"}
    (tmp_path / "c.csv").write_text('id,text\n1,"a ""q""\nb"\n')
    assert sources.read_csv(spark, str(tmp_path / "c.csv")).first().text == 'a "q"\nb'
    import pyarrow as pa

    table = pa.table({"id": [1, 2], "text": ["a", "b"], "more": [0.1, 0.2]})
    for name, opener in (("f.arrow", pa.ipc.new_file), ("s.arrow", pa.ipc.new_stream)):
        (tmp_path / name[0]).mkdir()
        with opener(str(tmp_path / name[0] / name), table.schema) as w:
            w.write_table(table)
        assert [r.text for r in sources.read_arrow(spark, str(tmp_path / name[0]), "text string, id long").orderBy("id").collect()] == ["a", "b"]
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9</p>"
    other = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\nxx"
    warc = b""
    for k, payload in enumerate((page, other)):
        warc += b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r%d>\r\nWARC-Target-URI: http://a.b/\r\nWARC-Date: 2020\r\nContent-Length: %d\r\n\r\n" % (k, len(payload)) + payload + b"\r\n\r\n"
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "x.warc").write_bytes(warc)
    rows = sources.read_warc(spark, str(tmp_path / "w")).collect()
    assert [(r.id, r.text, r.date) for r in rows] == [("<r0>", "<p>café</p>", "2020")]
    refs = spark.createDataFrame([("x.warc", 0, 4), ("nofile", 0, 4)], "path string, offset long, length long")
    assert {bytes(r.media_bytes) if r.media_bytes else None for r in sources.read_media(spark, str(tmp_path / "w"), refs).collect()} == {b"WARC", None}


def test_stream_rate_windows(spark, data, tmp_path):
    from vellum.streaming import rate_windows

    schema = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).schema
    spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "ev"))
    q = rate_windows(stream).writeStream.outputMode("complete").format("memory").queryName("rates").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
        n = spark.sql("SELECT sum(n) FROM rates").first()[0]
    finally:
        q.stop()
    assert n == spark.read.parquet(f"{data}/events.parquet").where("ts is not null").count()


def make_input(root):
    """Two shelves: a letter and its copy in another file, one line cut short, one record without a text."""
    lamps = "amber birch cedar delta ember fable grove haven ivory joker knoll lilac".split()
    letter = "My dear sister, the frost has come early. " + " ".join(f"We carried the {w} basket to the barn of {w[::-1]}, and {w[1:]} was left behind." for w in lamps)
    rows = {"shelf/letters.jsonl": [{"text": letter, "year": 1871}, {"title": "no text here"}], "drafts.jsonl": [{"text": letter}]}
    for name, items in rows.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps(x) + "\n" for x in items))
    with (root / "drafts.jsonl").open("a") as f:
        f.write('{"text": "cut')


def test_folder_run(spark, tmp_path):
    make_input(tmp_path / "in")
    stats = folder.FolderRun(spark, [str(tmp_path / "in")], str(tmp_path / "out")).run()
    assert (stats["input"], stats["survive"], stats["eliminated"]) == (4, 1, 3)
    assert set(stats["reasons"]) == {"invalid_json", "missing_text", "exact_dedup"}
    with pytest.raises(FileExistsError):
        folder.FolderRun(spark, [str(tmp_path / "in")], str(tmp_path / "out")).run()
    state = json.loads((tmp_path / "out" / "manifest.json").read_text())
    state["done"] = state["done"][:2]
    (tmp_path / "out" / "manifest.json").write_text(json.dumps(state))
    assert folder.FolderRun(spark, [str(tmp_path / "in")], str(tmp_path / "out"), resume=True).run() == stats
    (tmp_path / "in" / "three.jsonl").write_text("{}\n")
    with pytest.raises(ValueError):
        folder.FolderRun(spark, [str(tmp_path / "in")], str(tmp_path / "out"), resume=True).run()


def test_command_line(tmp_path):
    (tmp_path / "list.txt").write_text("# inputs\n\na\nb\n")
    a = folder.parse_arguments(["--input-folders-file", str(tmp_path / "list.txt"), "--page-marker", "[P]", "--dehyphenate-line-breaks", "out"])
    assert a.inputs == [str(tmp_path / "a"), str(tmp_path / "b")] and a.output == "out" and a.options.page_markers == ("[P]",) and a.options.dehyphenate_line_breaks
    with pytest.raises(ValueError):
        sources.roots([str(tmp_path), str(tmp_path / "a")])


def test_lines_are_numbered_over_blocks(spark):
    rows = [(f, b, 1000 * b + k, f"{f}{b}{k}") for f, blocks in (("a", (3, 1, 4)), ("b", (2,))) for b, n in enumerate(blocks) for k in range(n)]
    got = folder.numbered_lines(spark.createDataFrame(rows, "relpath string, block long, at long, raw string").repartition(5))
    assert {(r.relpath, r.line): r.raw for r in got.collect()} == {
        **{("a", i + 1): x for i, x in enumerate(["a00", "a01", "a02", "a10", "a20", "a21", "a22", "a23"])}, ("b", 1): "b00", ("b", 2): "b01",
    }


def test_classified_parts(spark):
    def predict(parts):
        return [{"good": 0.9, "bad": 0.1} if "lamp" in p else {"good": 0.2, "bad": 0.8} for p in parts]

    df = spark.createDataFrame([(1, "A lamp.\n\nA cart.\nA lamp again."), (2, "A cart."), (3, None), (4, "")], "doc_id long, text string")
    kept = {r.doc_id: r for r in filters.classified(df, predict, keep=[("good", 0.5)], mode="PARAGRAPH").collect()}
    assert kept[1].text == "A lamp.\n\nA lamp again." and kept[1].filter_reason is None and abs(kept[1].scores["good"] - 2 / 3) < 1e-9
    assert kept[2].filter_reason == "classifier" and kept[3].text is None and kept[3].filter_reason == kept[4].filter_reason == "classifier"
    assert {r.doc_id for r in filters.classified(df, predict, remove=[("bad", 0.5)]).where("filter_reason is null").collect()} == {1}


def test_parts_hashes_and_pages(spark):
    import xxhash

    text = "One line.  Two here.\nmore\n\n \nThree. Four"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    t = F.col("t")
    got = df.select(X.parts(t).alias("d"), X.parts(t, "PARAGRAPH").alias("p"), X.parts(t, "SENTENCE").alias("s"), X.parts(t, "WORDS").alias("w")).collect()
    assert got[0].d == [text] and got[0].p == ["One line.  Two here.\n", "more\n\n \n", "Three. Four"]
    assert "".join(got[0].s) == text and len(got[0].s) == 5 and len(got[0].w) == 7 and got[2].p == []
    h = df.select(X.xxhash_of(t).alias("a"), X.xxhash_of(t, 32).alias("b")).first()
    assert h.a % (1 << 64) == xxhash.xxh64_intdigest(text) and h.b == xxhash.xxh32_intdigest(text)
    pages = spark.createDataFrame([("abcdefg", [2, 5])], "t string, o array<int>")
    assert pages.select(X.pages(F.col("t"), F.col("o"))).first()[0] == ["ab", "cde"]
    form = spark.createDataFrame([("  Élan １2 — «Naïve»…\x07 ",)], "t string")
    assert form.select(X.perplexity_form(F.col("t"))).first()[0] == 'elan 00  -  "naive"...'
    urls = spark.createDataFrame([("https://u@Sub.A.co.uk:80/x",), ("//b.org.",), ("nothing",), (None,)], "u string")
    from vellum.operators import stats

    assert [tuple(r) for r in urls.select(stats.host(F.col("u")).alias("h")).select("h", stats.suffix(F.col("h"))).collect()][:2] == [("sub.a.co.uk", "co.uk"), ("b.org", "org")]


def test_seam_grams(spark):
    q, a = "a b c d e", "f g h i j"
    items = spark.createDataFrame([(1, a, q, "t")], "item_id long, label string, query string, task string")
    docs = spark.createDataFrame([(1, "x b c d e f y"), (2, "d e f g h"), (3, "a b c d e"), (4, "f g h i j"), (5, "a b c")], "doc_id long, text string")

    def found(**modes):
        index = decontaminate.pair_index(items, "label", "query", n=5, **modes)
        return sorted(r.doc_id for r in decontaminate.contaminated(docs, index, n=5).collect())

    assert found() == [1, 2, 4] and found(query_grams=True) == [1, 2, 3, 4] and found(overlap_grams=False) == [4]


def test_minhash_index_modes(spark):
    def word(i):
        return "".join(chr(97 + (i // 17**k) % 17) for k in range(3))

    base = " ".join(word(i) for i in range(300))
    near = base.replace(word(5), "other")
    own = " ".join("z" + word(i) for i in range(300))
    df = spark.createDataFrame([(1, base), (2, near), (3, own), (4, own), (5, "too short")], "doc_id long, text string")
    old = spark.createDataFrame([(9, near)], "doc_id long, text string")
    sigs, index = dedup.minhash_signatures(df), dedup.band_index(dedup.minhash_signatures(old))
    assert {r.doc_id for r in dedup.minhash_dedup_against(df, sigs, index, only_index=True).collect()} == {3, 4, 5}
    assert {r.doc_id for r in dedup.minhash_dedup_against(df, sigs, index).collect()} == {3, 5}
    # a cluster goes whole where only some of it is known
    far = index.where("band = -1").unionByName(sigs.where("doc_id = 2 and band = 0").select("band", "sig"))
    lone = sigs.where("doc_id in (1, 2)").join(far.select("sig"), "sig", "left_semi").select("doc_id").distinct().count()
    assert {r.doc_id for r in dedup.minhash_dedup_against(df, sigs, far).collect()} == {3, 5} and lone >= 1


def test_steps(spark):
    df = spark.range(5)
    assert run_steps(df, [lambda x: x.where("id > 1"), lambda x: x.withColumn("two", F.lit(2))]).count() == 3
