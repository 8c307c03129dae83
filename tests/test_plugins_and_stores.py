"""Model plug-ins, called workflows, documents of several kinds, databases, stores, arithmetic."""

import io
import json
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from sparvane.functions import arithmetic, text
from sparvane.operators import code, digest, models
from sparvane.sources import documents, files, http, stores


@pytest.fixture
def echo():
    return lambda prompts: [p.rsplit("\n", 1)[-1].upper() for p in prompts]


def test_models(spark, echo):
    frame = spark.createDataFrame([(1, "good day"), (2, None), (3, "")], "id int, t string")
    assert {r["id"]: r["a"] for r in frame.select("id", models.complete(F.col("t"), echo).alias("a")).collect()} == {1: "GOOD DAY", 2: None, 3: ""}
    with pytest.raises(Exception, match="one answer per prompt"):
        frame.select(models.complete(F.col("t"), lambda p: [])).collect()
    answers = ['{"a": 1, "b": "x"}', 'Sure!\n```json\n{"a": 2, "b": "y"}\n```', "{'a': 3, 'b': 'z',}", "no", None]
    rows = spark.createDataFrame([(k, a) for k, a in enumerate(answers)], "k int, t string").select("k", models.parse_answer(F.col("t"), "a int, b string").alias("r"))
    got = {r["k"]: r["r"] and tuple(r["r"]) for r in rows.collect()}
    assert got == {0: (1, "x"), 1: (2, "y"), 2: (3, "z"), 3: (None, None), 4: (None, None)} or got == {0: (1, "x"), 1: (2, "y"), 2: (3, "z"), 3: None, 4: None}

    def extractor(prompts):
        return [json.dumps({"n": len(p.split("\n", 1)[1])}) for p in prompts]

    out = models.extract_fields(frame.where("id = 1"), "t", {"n": "int"}, extractor).first()
    assert out["extracted"]["n"] == 8
    labelled = models.classify_by_model(frame, "t", ["Positive", "Negative"], lambda ps: ["positive " if "good" in p else "?" for p in ps])
    assert {r["id"]: r["label"] for r in labelled.collect()} == {1: "Positive", 2: None, 3: None}


def test_questions_and_agents(spark, echo):
    texts = spark.createDataFrame([(1, "cats sleep all day"), (2, "dogs run"), (3, None), (4, "cats and dogs")], "doc_id long, text string")
    asked = spark.createDataFrame([(7, "do cats sleep"), (8, "zebras")], "question_id long, question string")
    got = {r["question_id"]: (r["sources"], r["answer"]) for r in models.answer_questions(asked, texts, echo, k=2).collect()}
    assert got == {7: ([1, 4], "QUESTION: DO CATS SLEEP"), 8: ([], "QUESTION: ZEBRAS")}

    def thinker(prompts):
        return [json.dumps({"answer": p.rsplit("= ", 1)[1]}) if "= " in p else '{"tool": "add", "input": "2+3"}' if "add" in p.split("\n", 1)[1] else "hm" for p in prompts]

    goals = spark.createDataFrame([(1, "add it"), (2, "wait"), (3, None)], "id int, goal string")
    tools = {"add": lambda x: str(arithmetic.evaluate(x))}
    assert {r["id"]: r["a"] for r in goals.select("id", models.agent(F.col("goal"), thinker, tools, 3).alias("a")).collect()} == {1: "5.0", 2: None, 3: None}


def test_called_workflows(spark):
    @code.workflow("double")
    def double(df, by=2):
        return df.withColumn("x", F.col("x") * by)

    @code.workflow("loop")
    def loop(df):
        return code.call_workflow("loop", df)

    frame = spark.createDataFrame([(2,)], "x int")
    assert code.call_workflow("double", frame, by=5).first()["x"] == 10
    for name, error in (("loop", RecursionError), ("none", KeyError)):
        with pytest.raises(error):
            code.call_workflow(name, frame)
    assert code.call_workflow("double", frame).first()["x"] == 4


def pdf(*lines):
    body = b"BT /F1 12 Tf " + b" T* ".join(b"(" + x + b") Tj" for x in lines) + b" ET"
    packed = zlib.compress(body)
    return b"%PDF-1.4\n1 0 obj << /Length 1 /Filter /FlateDecode >>\nstream\n" + packed + b"\nendstream\nendobj\n%%EOF"


def test_documents(spark, tmp_path):
    word = io.BytesIO()
    with zipfile.ZipFile(word, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="u"><w:p><w:t>One</w:t><w:t> two</w:t></w:p><w:p><w:t>Three</w:t></w:p></w:document>')
    made = {
        "a.txt": "plain é".encode(), "b.md": b"# Head", "c.html": b"<title>T</title><p>x <b>y</b></p><script>z</script>", "d.json": b'["p", {"q": 1}]', "e.csv": b"k,v\n1,2\n3,4\n",
        "f.xlsx": documents.sheet_file([["n", "t"], [1.5, "a & b"], [None, "é"]]), "g.docx": word.getvalue(), "h.pdf": pdf(b"Hello \\(you\\)", b"next"), "i.xlsx": b"broken", "j.json": b"{",
    }
    for name, content in made.items():
        (tmp_path / name).write_bytes(content)
    got = {}
    for r in documents.load_documents(spark, str(tmp_path)).collect():
        got.setdefault(r["source"].rsplit("/", 1)[1], []).append((r["part"], r["text"], r["error"] is None))
    assert {k: sorted(v) for k, v in got.items() if k[0] not in "ij"} == {
        "a.txt": [(0, "plain é", True)], "b.md": [(0, "# Head", True)], "c.html": [(0, "x y", True)], "d.json": [(0, "p", True), (1, '{"q": 1}', True)],
        "e.csv": [(0, "k: 1\nv: 2", True), (1, "k: 3\nv: 4", True)], "f.xlsx": [(0, "n\tt\n1.5\ta & b\n\té", True)], "g.docx": [(0, "One two\nThree", True)],
        "h.pdf": [(0, "Hello (you)\nnext", True)],
    }
    assert [x[1:] for x in got["i.xlsx"] + got["j.json"]] == [(None, False)] * 2


def test_database(spark):
    url = "jdbc:derby:memory:sparvane;create=true"
    stores.execute(spark, url, 'CREATE TABLE t ("id" BIGINT PRIMARY KEY, "v" VARCHAR(20))')
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    stores.write_table(rows, url, "t")
    stores.upsert_table(spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string"), url, "t", ["id"])
    assert sorted(tuple(r) for r in files.read_table(spark, url, 'SELECT "id", "v" FROM t').collect()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(Exception):
        stores.upsert_table(spark.createDataFrame([(4, "x" * 30)], "id long, v string"), url, "t", ["id"])
    assert files.read_table(spark, url, "SELECT * FROM t").count() == 3


def test_store(spark, tmp_path):
    store = stores.KeyValueStore(spark, str(tmp_path / "kv"))
    assert store.get().count() == 0
    store.put(spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), (None, "x")], "key string, value string"))
    store.put(spark.createDataFrame([("a", "0"), ("c", None), ("b", None)], "key string, value string"))
    read = lambda: sorted(tuple(r) for r in store.get().collect())
    assert read() == [("a", "0")]
    store.compact()
    assert read() == [("a", "0")] and store.get(spark.createDataFrame([("b",)], "key string")).count() == 0


@pytest.mark.parametrize(
    ("expression", "value"),
    [("1 + 2*3", 7), ("2^10", 1024), ("-(4-6)/4", 0.5), ("sqrt(9)+max(1, 2)", 5), ("7 % 4", 3), ("1/0", None), ("", None), ("__import__('os')", None), ("x", None), ("9**9**9", None), ("1 <", None)],
)
def test_arithmetic(expression, value):
    assert arithmetic.evaluate(expression) == value


def test_text_helpers(spark):
    rows = spark.createDataFrame([(1, "One two, three.  Four"), (2, ""), (3, None), (4, "  ")], "id int, t string")
    got = {r["id"]: r["c"] for r in rows.select("id", text.chunk_tokens(F.col("t"), 3, 1).alias("c")).collect()}
    assert got == {1: ["One two,", ", three.", ".  Four"], 2: [], 3: None, 4: []}
    maps = spark.createDataFrame([(1, {"u": "https://a.example/v1/x", "n": None, "w": "b"})], "id int, p map<string,string>")
    out = maps.select(text.replace_urls(F.col("p"), {"https://a.example": "A_URL", "https://a.example/v1": "A_V1"}).alias("p")).first()["p"]
    assert out == {"u": "{{ $env.A_V1 }}/x", "n": None, "w": "b"}


def test_graphql_and_figures():
    seen = []

    def post(url, body=None):
        seen.append(body and json.loads(body))
        return json.dumps({"data": {"list": [1, 2]}}) if body else '{"total": 3}'

    reader = http.PagedReader({"url": "x", "pages": "2", "query": "q", "variables": '{"a": 1}', "items": "data.list"}, post)
    assert [x for p in reader.partitions() for x in reader.read(p)] == [(0, "1"), (0, "2"), (1, "1"), (1, "2")]
    assert seen == [{"query": "q", "variables": {"a": 1, "page": k}} for k in range(2)]
    assert list(http.PagedReader({"url": "stats"}, post).read(http._Pages(0, 1))) == [(0, '{"total": 3}')]
    with pytest.raises(RuntimeError):
        list(http.PagedReader({"url": "x", "query": "q"}, lambda *_: '{"errors": ["no"]}').read(http._Pages(0, 1)))


def test_sitemap_and_digest(spark, tmp_path):
    (tmp_path / "s.xml").write_text("<urlset><url><loc>https://a.example/x</loc></url><url><loc>https://a.example/y</loc><lastmod>2024</lastmod></url></urlset>")
    assert [tuple(r) for r in files.read_sitemap(spark, str(tmp_path / "s.xml"), "/y$").collect()] == [("https://a.example/y", "2024")]
    records = spark.createDataFrame([(1, "t", "Acme sells new things", "u", "s", "2024-01-01"), (2, "t", "nothing", "u", "s", "2024-01-01")], "id int, title string, summary string, url string, source string, publish_date string")
    companies = spark.createDataFrame([("Acme", "acme")], "company string, token string")
    counts, page = digest.build_digest(records, companies, [("product_launches", ["new"])], "2024-01-01")
    assert tuple(counts.first()) == (2, 2, 1) and "## product_launches / Acme" in page.first()["text"]


def test_incremental_loop_and_feed(spark, tmp_path):
    store = stores.KeyValueStore(spark, str(tmp_path / "marks"))
    rows = spark.createDataFrame([(k, k * 10) for k in range(5)] + [(9, None)], "id long, at long")
    fresh, remember = stores.new_since(rows.where("id < 3 or id = 9"), "at", store, "loop")
    assert fresh.count() == 3 and stores.new_since(rows, "at", store, "loop")[0].count() == 5
    remember()
    fresh, remember = stores.new_since(rows, "at", store, "loop")
    assert sorted(r["id"] for r in fresh.collect()) == [3, 4]
    remember()
    stores.new_since(rows, "at", store, "loop")[1]()
    assert stores.new_since(rows, "at", store, "loop")[0].count() == 0
    polls = [[(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")], [(3, "d")]]
    got = []
    for poll in polls:  # each by a reader that was opened anew
        feed = stores.SnapshotFeed(spark, str(tmp_path / "feed"))
        got.append(sorted(tuple(r) for r in feed.poll(spark.createDataFrame(poll, "id long, v string"), ["id"]).collect()))
    assert got == [
        [(1, "insert", None, "a"), (2, "insert", None, "b")],
        [(2, "update", "b", "c"), (3, "insert", None, "d")],
        [(1, "delete", "a", None), (2, "delete", "c", None)],
    ]
