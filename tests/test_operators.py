"""Resolution, relations, evidence, models and files on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from skeinwork.operators import census as C
from skeinwork.operators import entities as E
from skeinwork.operators import models as M
from skeinwork.operators import relations as R
from skeinwork.operators import stats as S
from skeinwork.operators.evidence import pick_text
from skeinwork.sources import files, sinks
from skeinwork.streaming import ingest

MENTION = "ord int, standard_name string, original_text_name string, aliases array<string>, type string, context string, time_period string, source_file string"
EDGE = "edge_id bigint, source string, target string, relationship string, detail string, context string, time_period string, wikipedia_urls array<string>"


def test_merge_mentions(spark):
    rows = [
        (2, "the  GANG", "g", ["b", None, ""], "mafia", "long text", None, "f2"),
        (1, "The Gang", None, None, "", "text", "1990", "f1"),
        (3, "The Gang ", "g", ["a", "b"], "clan", "same size", "1991", "f1"),
        (4, " ", "g", [], "clan", "x", "y", "f1"),
        (5, None, "g", [], "clan", "x", "y", "f1"),
    ]
    for n in (1, 5):
        r = E.merge_mentions(spark.createDataFrame(rows, MENTION).repartition(n), F.col("ord")).collect()
        assert len(r) == 1
        r = r[0]
        assert (r.standard_name, r.type, r.context, r.time_period, r.aliases, r.source_articles) == ("The Gang", "criminal_organization", "long text", "1990", ["a", "b"], ["f1", "f2"])
    assert E.merge_mentions(spark.createDataFrame([], MENTION), F.col("ord")).count() == 0


def test_canonical_one_hop(spark):
    nodes = spark.createDataFrame([(1, "A", ["x"], ["n"]), (2, "B", None, None), (3, "C", [], [])], "id int, standard_name string, aliases array<string>, original_text_names array<string>")
    nodes = nodes.withColumns({"type": F.lit("gang"), "context": F.lit(""), "time_period": F.lit(None).cast("string"), "source_articles": F.array().cast("array<string>"), "wikipedia_urls": F.array().cast("array<string>")})
    variants = spark.createDataFrame([(1, "B", "a"), (2, "C", "b")], "entry int, canonical string, variant string")
    got = {r.standard_name: r.aliases for r in E.apply_canonical(nodes, variants, F.col("id")).collect()}
    assert got == {"B": ["A", "x"], "C": ["B"]}  # A becomes B, though B becomes C


def test_generic(spark):
    df = spark.createDataFrame([("Irish Gangs",), ("irish mob",), ("the lot",), ("Green Gang",), (None,)], "n string")
    got = [r[0] for r in df.select(E.is_generic(F.col("n"), ("irish",), ("irish mob",), ("the lot",))).collect()]
    assert got == [True, False, True, False, None]


def test_split_sources(spark):
    urls = ["https://e/wiki/", "https://e/wiki/Other", "https://e/wiki/Big_Gang_of", "https://e/wiki/Big_Gang"]
    df = spark.createDataFrame([("Big Gang", None, urls), ("Other One", ["OTHER"], urls), ("x", [], None)], "standard_name string, aliases array<string>, wikipedia_urls array<string>")
    got = [(r.own_source and r.own_source.title, len(r.mentioned_in)) for r in E.split_sources(df).collect()]
    assert got == [("Big Gang of", 3), ("Other", 3), (None, 0)]
    over = spark.createDataFrame([("big gang", None, None), ("x", "https://z", "Z")], "name string, url string, title string")
    got = {r.standard_name: (r.own_source and r.own_source.title, len(r.mentioned_in)) for r in E.split_sources(df, over).collect()}
    assert got == {"Big Gang": (None, 4), "Other One": ("Other", 3), "x": ("Z", 0)}


def edges(spark, rows):
    return spark.createDataFrame([r + (None,) * (8 - len(r)) for r in rows], EDGE)


def test_pairs(spark):
    e = edges(spark, [(1, "a", "b", "alliance", None, "one", "1990", ["u1"]), (2, "b", "a", "rivalry", None, "two", "1995", ["u2", "u1"]), (3, "a", "b", "other", None, "one", "1995"), (4, "c", "d", "rivalry", None, "x", "1990s"), (5, "d", "c", "rivalry", None, "y", "2000"), (6, "e", "e", "other")])
    kept = R.one_per_pair(e, F.col("edge_id"), 2030)
    assert {(r.a, r.b): (r.edge_id, r.resolved) for r in kept.collect()} == {("a", "b"): (2, "date"), ("c", "d"): (4, "chooser"), ("e", "e"): (6, "single")}
    fold = {(r.a, r.b): (r.descriptions, r.urls) for r in R.fold_provenance(kept, e, F.col("edge_id")).collect()}
    assert fold[("a", "b")] == (["two", "one"], ["u2", "u1"])
    assert fold[("e", "e")] == (None, None)
    counts = R.resolution_counts(kept).first()
    assert tuple(counts) == (3, 1, 1, 1, 3)


def test_chooser(spark):
    e = edges(spark, [(4, "c", "d", "rivalry", None, "x", None), (5, "d", "c", "rivalry", None, "y", None), (7, "m", "n", "other"), (8, "m", "n", "other")])

    class Second:
        def __call__(self, prompt, max_tokens):
            return ('{"choice": 1}' if "c and d" in prompt else '{"choice": 9}'), False

    kept = R.one_per_pair(e, F.col("edge_id"), 2030, M.model_chooser(Second))
    assert sorted((r.a, r.edge_id) for r in kept.collect()) == [("c", 5), ("m", 7)]


def test_detail_case(spark):
    e = edges(spark, [(1, "A", "b", "Alliance", "Wing"), (2, "a", "B", "alliance", "wing"), (3, "a", "b", " ", "wing"), (4, None, "b", "other"), (5, "b", "a", "alliance", "wing")])
    assert R.merge_edges(e, F.col("edge_id")).count() == 2
    assert R.merge_edges(e, F.col("edge_id"), lower_detail=False).count() == 3
    assert R.merge_edges(edges(spark, []), F.col("edge_id")).count() == 0


def test_ask_retries():
    waits, calls = [], []

    def client(prompt, tokens):
        calls.append((tokens, prompt.endswith("JSON only.")))
        if len(calls) == 1:
            raise RuntimeError("HTTP 429")
        return ('{"a"', True) if len(calls) == 2 else ('```json\n{"a": 1}\n```', False)

    assert M.ask(client, "p", sleep=waits.append) == '{"a": 1}'
    assert calls == [(8192, False), (8192, True), (16384, True)] and waits == [10.0]
    assert M.ask(lambda p, t: ("no", False), "p", sleep=waits.append) is None


def test_extractions(spark):
    answers = [("f", 1, json.dumps({"nodes": [{"standard_name": "A"}], "edges": []})), ("f", 2, None), ("g", 1, '{"nodes": null}')]
    df = spark.createDataFrame(answers, "folder_name string, chunk_no int, answer string")
    got = {r.folder_name: (len(r.nodes), r.incomplete, r.failed_chunks, r.total_chunks) for r in M.extractions(df).collect()}
    assert got == {"f": (1, True, 1, 2), "g": (0, False, 0, 1)}


def test_tiers(spark):
    words = lambda n: " ".join(["Xy"] * n)
    src = "struct<url:string,title:string>"
    rows = [("Own", "gang", ["d"], ("u1", "t"), []), ("Xy", "gang", ["d"], ("u2", "t"), [("u1", None), ("u3", "T")]), ("No", "gang", [" d "], None, [("u9", "z")]), ("Nil", "gang", [], None, None)]
    ents = spark.createDataFrame(rows, f"name string, type string, descriptions array<string>, own_source {src}, mentioned_in array<{src}>")
    arts = spark.createDataFrame([("a", "u1"), ("b", "u2"), ("c", "u3"), ("z", None)], "folder_name string, url string")
    texts = spark.createDataFrame([("a", words(30)), ("b", words(29)), ("c", "zz\n\nxy here")], "folder_name string, content string")
    got = {r.name: (r.method, r.text) for r in pick_text(ents, arts, texts).collect()}
    assert got["Own"] == ("own_source", words(30))
    assert got["Xy"] == ("mentioned_in", f"[from article: Wikipedia]\n{words(30)}\n\n[from article: T]\nxy here")
    assert got["No"] == ("name_only", "d") and got["Nil"] == ("name_only", "")


def test_keep_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "n int, k string")
    assert sorted(r.n for r in C.keep_first(df, [F.col("k")], F.col("n")).collect()) == [1, 3, 4]


def test_statistics(spark):
    signed = spark.createDataFrame([(str(i), i % 3, 1, i % 3 + 1) for i in range(10)] + [("z", 1, 0, 1)], "v string, d_pos int, d_neg int, total int")
    types = spark.createDataFrame([(str(i), "gang") for i in range(10)] + [("z", "clan")], "v string, type string")
    r = S.alliance_share_interval(signed, types).collect()
    assert [x.type for x in r] == ["gang"] and r[0].ci_lo < 0.48 < r[0].ci_hi
    assert r == S.alliance_share_interval(signed.repartition(3), types).collect()
    cells = spark.createDataFrame([("a", "x", "x", 50), ("a", "x", "y", 5), ("a", "y", "y", 40), ("b", "x", "y", 9), ("b", "x", "x", 9)], "layer string, type_a string, type_b string, n int")
    boot = {x.layer: x for x in S.bootstrap_assortativity(cells).collect()}
    assert boot["a"].mean == pytest.approx(0.8935, abs=0.01) and boot["a"].se > 0
    z = S.z_test(S.bootstrap_assortativity(cells), "a", "b").first()
    assert z.z < -5 and z.p < 1e-6


def test_files(spark, tmp_path):
    for name, body in (("A", '{"nodes": [{"standard_name": "N"}], "edges": [], "source_file": "A"}'), ("B b", "{broken"), ("C+", '{"nodes": [], "edges": [], "incomplete": true}')):
        (tmp_path / "t" / name).mkdir(parents=True)
        (tmp_path / "t" / name / "extracted.json").write_text(body)
        (tmp_path / "t" / name / "content.txt").write_text(f"text of {name}\nmore")
    (tmp_path / "t" / "A" / "url.txt").write_text("https://x \n")
    good, bad = files.extraction_records(spark, str(tmp_path / "t"))
    assert sorted(r.folder_name for r in good.collect()) == ["A", "C+"] and [r.folder_name for r in bad.collect()] == ["B b"]
    assert sorted(r.folder_name for r in files.failed(good).collect()) == ["C+"]
    texts = {r.folder_name: (r.content, r.url) for r in files.article_texts(spark, str(tmp_path / "t")).collect()}
    assert texts["A"] == ("text of A\nmore", "https://x") and texts["B b"][1] is None
    nodes, _ = files.tagged(good, files.article_texts(spark, str(tmp_path / "t")))
    assert [(r.standard_name, r.url) for r in nodes.collect()] == [("N", "https://x")]


def test_lists_and_sinks(spark, tmp_path):
    (tmp_path / "u.csv").write_text('url\n"https://a",x\n\nftp://b\nhttps://c\n')
    assert [r.url for r in files.url_list(spark, str(tmp_path / "u.csv")).orderBy("at").collect()] == ["https://a", "https://c"]
    rows = spark.createDataFrame([('T "q"', "f", "u, v")], "title string, folder_name string, url string")
    sinks.write_index(rows, str(tmp_path / "i"))
    assert files.article_index(spark, str(tmp_path / "i")).collect() == rows.collect()
    p = str(tmp_path / "v")
    assert sinks.replace_with_backup(spark.range(3), p) is None
    backup = sinks.replace_with_backup(spark.read.parquet(p).filter("id > 0"), p)
    assert spark.read.parquet(p).count() == 2 and spark.read.parquet(backup).count() == 3
    sinks.append_done(spark.range(5, 6), p)
    assert files.unfinished(spark.range(8), spark.read.parquet(p), "id").count() == 5
    doc = sinks.network_document(spark.createDataFrame([("é",)], "standard_name string"), spark.createDataFrame([("a", "b")], "source string, target string")).first().value
    assert json.loads(doc)["metadata"] == {"description": "", "total_nodes": 1, "total_edges": 1} and "é" in doc
    (tmp_path / "n.json").write_text(doc)
    n, e = files.network(spark, str(tmp_path / "n.json"))
    assert n.first().standard_name == "é" and e.first().target == "b"
    assert "id" in sinks.report(spark.range(1))


class FakeWiki:
    def oldid(self, lang, title):
        return (7, None) if title == "A" else (None, "not found")

    def extract(self, lang, oldid):
        return "text" if oldid == 7 else None

    def html(self, lang, oldid):
        raise RuntimeError("down")


def test_fetch(spark):
    df = spark.createDataFrame([("en", "A"), ("en", "B")], "lang string, title string")
    assert sorted((r.title, r.oldid, r.reason) for r in files.resolve_revisions(df, FakeWiki).collect()) == [("A", 7, None), ("B", None, "not found")]
    urls = spark.createDataFrame([("https://en.w.org/?title=A&oldid=7",), ("https://en.w.org/?oldid=8",), ("https://en.w.org/x",)], "url string")
    got = sorted((r.content or "", r.infobox, r.error or "") for r in files.fetch_articles(urls, FakeWiki).collect())
    assert got == [("", "", "no revision in the address"), ("", "", "no text"), ("text", "", "")]


def test_stream_takes_new_files_only(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("s", "o", "c"))
    spark.range(3).write.parquet(src)
    schema = spark.range(1).schema
    for expected in (3, 3, 5):
        if expected == 5:
            spark.range(10, 12).write.mode("append").parquet(src)
        ingest.ingest(ingest.new_records(spark, src, schema), out, cp).awaitTermination()
        assert spark.read.schema(schema).parquet(out).count() == expected


def test_late_and_repeated_deliveries(spark, tmp_path):
    import datetime as dt

    t = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    rows = [(1, "a", t(0)), (1, "a", t(3)), (2, "a", t(1)), (3, "b", t(9))]
    df = spark.createDataFrame(rows, "id int, standard_name string, at timestamp").coalesce(1)
    df.write.parquet(str(tmp_path / "s"))
    stream = ingest.new_records(spark, str(tmp_path / "s"), df.schema)
    out = str(tmp_path / "once")
    ingest.ingest(ingest.deliveries(stream, "id", "at"), out, str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    counts = ingest.mention_counts(stream, "at", "7 days", "1 day")
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.standard_name, r.n) for r in spark.sql("select * from counts").collect())
    assert got == [("a", 1), ("a", 2), ("b", 1)] or got == [("a", 3), ("b", 1)]


def test_countries_and_prompts(spark):
    from skeinwork.functions.records import country_prompt

    df = spark.createDataFrame([("N", "own_source", '```json\n{"country": "Peru", "countries_active": ["Chile"], "confidence": "High"}\n```'), ("M", "name_only", None)], "name string, method string, answer string")
    got = {r.name: (r.country, r.countries_active, r.country_confidence, r.country_method) for r in M.countries(df).collect()}
    assert got == {"N": ("Peru", ["Peru", "Chile"], "high", "own_source"), "M": ("Unknown", [], "low", "name_only")}
    p = df.select(country_prompt(F.col("name"), F.lit(None).cast("string"), F.col("method"), F.lit("text"))).first()[0]
    assert "Name: N\nKind: not known\n" in p and p.endswith("<text>\ntext\n</text>")
    own = df.select(country_prompt(F.col("name"), F.lit("gang"), F.col("method"), F.lit("text"), "Say it.")).first()[0]
    assert own.startswith("Say it.\n\nName: N\nKind: gang\n")
    left = M.with_countries(df.select("name").union(df.selectExpr("'Q'")), M.countries(df)).collect()
    assert {r.name: (r.country, r.countries_active, r.country_confidence, r.country_method) for r in left}["Q"] == ("Unknown", [], "low", None)


def test_final_tables(spark):
    nodes = spark.createDataFrame([(1, "A", "gang", "ctx", "", ["https://x/wiki/A"], None), (2, "Irish Mafia", "mafia", "", "1990", None, None), (3, "B", "other", "c", None, [], None), (4, "C", "clan", None, None, None, ["A"])], "node_id int, standard_name string, type string, context string, time_period string, wikipedia_urls array<string>, aliases array<string>")
    ents = E.final_entities(nodes, prefixes=("irish",))
    got = {r.name: (r.type, r.descriptions, r.time_period, r.own_source and r.own_source.title) for r in ents.collect()}
    assert got == {"A": ("gang", ["ctx"], None, "A"), "C": ("clan", [], None, None)}
    e = edges(spark, [(1, "A", "C", "alliance", None, "t", None, ["https://x/?title=A_b", "https://x/"]), (2, "A", "B", "alliance"), (3, "A", "C", "other"), (4, "a", "C", "rivalry")])
    rel = R.final_relations(e, ents).collect()
    assert [(r.source, r.target, r.type, r.descriptions, [s.title for s in r.sources]) for r in rel] == [("A", "C", "allied_with", ["t"], ["A b", "Wikipedia"])]


def test_retries_of_services(spark):
    from skeinwork.operators.models import again
    from skeinwork.sources.files import revision_of

    waited, calls = [], iter([RuntimeError("429"), RuntimeError("HTTP 429 Too Many Requests"), "page"])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert again(call, sleep=waited.append) == "page" and waited == [5.0, 10.0]
    with pytest.raises(ValueError):
        again(lambda: int("x"), sleep=waited.append)

    class Empty:
        def __init__(self, answers):
            self.answers = iter(answers)

        def oldid(self, lang, title):
            return next(self.answers)

    waited.clear()
    assert revision_of(Empty([(None, "empty"), (None, "empty"), (7, None)]), "en", "x", sleep=waited.append) == (7, None) and waited == [3.0, 6.0]
    waited.clear()
    assert revision_of(Empty([(None, "not found")]), "en", "x", sleep=waited.append) == (None, "not found") and not waited


def test_sets_of_a_hot_group(spark):
    from skeinwork.operators.entities import with_sets

    rows = spark.createDataFrame([("a", ["x", None, ""]), ("a", ["y", "x"]), ("b", None), ("b", [])], "k string, s array<string>")
    got = with_sets(rows.select("k").distinct(), rows, ["k"], {"s": rows["s"]})
    assert {r.k: r.s for r in got.collect()} == {"a": ["x", "y"], "b": []}


def test_network_beyond_one_document(spark, tmp_path):
    from skeinwork.sources import files, sinks

    nodes = spark.createDataFrame([("A", ["a"]), ("B", None)], "standard_name string, aliases array<string>")
    edges = spark.createDataFrame([("A", "B")], "source string, target string")
    for most, one in ((10, True), (2, False)):
        path = f"file://{tmp_path}/n{most}"
        assert sinks.write_network(nodes, edges, path, "d", most) is one
        n, e = files.network(spark, path)
        assert sorted(r.standard_name for r in n.collect()) == ["A", "B"] and [(r.source, r.target) for r in e.collect()] == [("A", "B")]


def test_infobox_of_a_page_without_ends():
    from skeinwork.functions.infobox import infobox_text

    assert infobox_text("<div>" * 20_000 + "<table class=infobox><tr><th>K</th><td>v" + "<b>" * 20_000 + "w") == "K: v w"
