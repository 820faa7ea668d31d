"""Text expressions against Python's own string, regex and HTML tools."""

import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from outbreaklens.functions import html, text as t
from outbreaklens.operators import bulletins

TEXTS = [
    "",
    "No figure here.",
    "As of 30 July, a total of 1,234 confirmed cases,\nincluding 587 deaths, were reported. 17 863 contacts; 9 cases",
    "12 Cases 13 suspected  case and 14 probable cases, 3 death",
    "😀" * 70 + " 5 cases " + "é" * 30 + "\n 6 deaths",
    "7 cases and 8\tdeaths 99999999999999999999 cases ,12 cases",
    "1 case2 cases3 deaths" * 40,
    "٣ cases, 1٢,٠ deaths and ５６ suspected cases",
    "x" * 200 + "44 confirmed\n\ncases" + "y" * 200 + "\n" + "z" * 60 + "\n" + "w" * 61 + "\n  " + "v" * 61 + "  ",
]


def python_mentions(text: str) -> list[tuple]:
    """Mentions by cutting the text at each match: what stands in front, the match, what follows."""
    patterns = {
        "cases": r"(?i)(\d[\d,]*)\s+(?:confirmed\s+|suspected\s+)?cases?",
        "deaths": r"(?i)(\d[\d,]*)\s+deaths?",
    }
    found = []
    for kind, pattern in patterns.items():
        done, rest = "", text
        while hit := re.search(pattern, rest):
            done, after = done + rest[: hit.start()], rest[hit.end() :]
            window = " ".join((done[-60:] + hit[0] + after[:20]).split("\n"))
            number = int("".join(hit[1].split(",")))
            found.append((number if number < 2**63 else None, kind, "..." + window.strip() + "..."))
            done, rest = done + hit[0], after
    return found


@pytest.mark.parametrize("text", TEXTS)
def test_mentions_and_context(spark, text):
    got = spark.createDataFrame([(text,)], "c string").select(t.count_mentions(F.col("c"))).first()[0]
    assert [tuple(m) for m in got] == python_mentions(text)


@pytest.mark.parametrize("text", TEXTS)
def test_paragraphs(spark, text):
    got = spark.createDataFrame([(text,)], "c string").select(t.paragraphs(F.col("c"))).first()[0]
    assert got == list(filter(lambda line: len(line) > 60, map(str.strip, text.split("\n"))))


def test_preview_and_names(spark):
    df = spark.createDataFrame([("a" * 150, "b" * 151, "dir/DON614_2026-08-01.txt")], "a string, b string, f string")
    stem = t.file_stem(F.col("f"))
    row = df.select(
        t.preview(F.col("a")), t.preview(F.col("b")), stem, t.bulletin_number(stem), t.bulletin_date(stem).cast("string")
    ).first()
    assert tuple(row) == ("a" * 150, "b" * 150 + "...", "DON614_2026-08-01", "DON614", "2026-08-01")


def test_severity(spark):
    lines = [
        "Routine update: recovered patients were discharged and contacts stay under monitoring today",
        "The spread is rising and the surge has expanded with additional chains this reporting week",
        "A public health emergency of international concern: deaths and mortality are in crisis range",
        "Nothing in this paragraph says anything about the state of the outbreak in any direction",
    ]
    df = spark.createDataFrame([("\n".join(lines),), ("short",)], "c string")
    judged = [r[0] for r in df.select(t.paragraph_severity(F.col("c"))).collect()]
    assert [p["label"] for p in judged[0]] == [t.ROUTINE, t.ESCALATION, t.EMERGENCY, t.ROUTINE]
    assert judged[0][3]["confidence"] == 0.5 and judged[1] == []
    worst = [r[0] for r in df.select(t.most_severe(t.paragraph_severity(F.col("c")))).collect()]
    assert worst[0]["paragraph"] == lines[2] and worst[1] is None


def test_most_severe_takes_the_first_of_equals(spark):
    entry = "array<struct<paragraph:string,label:string,confidence:double>>"
    rows = [
        ([("a", t.ROUTINE, 0.9), ("b", t.ESCALATION, 0.95)],),
        ([("a", t.ROUTINE, 0.9), ("b", t.EMERGENCY, 0.4), ("c", t.EMERGENCY, 0.4)],),
    ]
    df = spark.createDataFrame(rows, f"s {entry}")
    assert [r[0]["paragraph"] for r in df.select(t.most_severe(F.col("s"))).collect()] == ["a", "b"]


def test_locations(spark):
    texts = [
        ("b1", "Cases in Bunia, Nord-Kivu and the Democratic Republic of the Congo; Bunia again."),
        ("b2", "Nothing."),
        ("b3", "Republic of the Congo; Buniaville; L’Aru"),
    ]
    names = [("Bunia",), ("Nord-Kivu",), ("Democratic Republic of the Congo",), ("Aru",), ("Republic of the Congo",)]
    texts, names = spark.createDataFrame(texts, "bulletin string, text string"), spark.createDataFrame(names, "name string")
    want = {
        "b1": ["Bunia", "Democratic Republic of the Congo", "Nord-Kivu", "Republic of the Congo"],
        "b3": ["Republic of the Congo"],
    }
    for limit in (1_000, 0):  # broadcast and shuffle join
        got = bulletins.locations(texts, names, broadcast_names=limit)
        assert {r["bulletin"]: r["locations_mentioned"] for r in got.collect()} == want
    records = bulletins.extract(texts, names)
    assert {r["bulletin"]: r["locations_mentioned"] for r in records.collect()}["b2"] == []


def test_caller_models(spark):
    texts = spark.createDataFrame([("b", "alert in Goma"), ("c", "calm")], "bulletin string, text string")

    def make_predict():
        import numpy as np

        def predict(batch):
            return np.array([[0.1, 0.2, 0.7] if "alert" in s else [0.8, 0.1, 0.1] for s in batch])

        return predict

    rows = texts.withColumnRenamed("text", "paragraph")
    judged = bulletins.severity_by_model(rows, make_predict, [t.ROUTINE, t.ESCALATION, t.EMERGENCY])
    assert {r["bulletin"]: (r["label"], r["confidence"]) for r in judged.collect()} == {
        "b": (t.EMERGENCY, 0.7),
        "c": (t.ROUTINE, 0.8),
    }
    found = bulletins.entities_by_model(texts, lambda s: [("Goma", "LOC"), ("X", "PER"), ("Goma", "LOC")] if "Goma" in s else [])
    assert {r["bulletin"]: r["locations_mentioned"] for r in found.collect()} == {"b": ["Goma"], "c": []}


class Reader(HTMLParser):
    """Text nodes of the first wanted element, by a tag stack."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted, self.depth, self.done, self.skip, self.nodes, self.open = wanted, 0, False, [], [], False

    def handle_starttag(self, tag, attrs):
        self.open = False
        if tag == self.wanted:
            self.depth += 1
        if tag in ("nav", "header", "footer", "script", "style"):
            self.skip.append(tag)

    def handle_endtag(self, tag):
        self.open = False
        if self.skip and self.skip[-1] == tag:
            self.skip.pop()
        if tag == self.wanted and self.depth:
            self.depth -= 1
            self.done = self.done or self.depth == 0

    def handle_comment(self, data):
        self.open = False

    def handle_data(self, data):
        if self.depth and not self.done and not self.skip:
            if self.open:
                self.nodes[-1] += data
            else:
                self.nodes.append(data)
            self.open = True


def python_article(page: str) -> str:
    for wanted in ("main", "article", "body"):
        if re.search(rf"<{wanted}[\s>]", page):
            reader = Reader(wanted)
            reader.feed(page)
            reader.close()
            return "\n".join(n.strip() for n in reader.nodes if n.strip())
    raise AssertionError("no region")


PAGES = [
    "<html><body><p>One</p><p> Two &amp; three </p></body></html>",
    "<body><nav>menu</nav><article class='a>b'><h1>T</h1><p>x<b>y</b> z</p><article>in</article>tail</article><article>other</article></body>",
    "<body><header>h<nav>n</nav>h2</header><main id=m>A<footer>f</footer>B<!-- <main> c -->C<script>if(a</b)'</main>'</script>D</main>E</body>",
    "<body><article>caf&eacute; &lt;tag&gt; &#233;&#x20AC; &amp;lt; &nbsp;x&nbsp; &copy; &quot;q&quot;<br/>&#38;amp;</article></body>",
    "<body><p>before</p><script>never closed <p>dropped</p>",
    '<body><p title="a > b">kept</p><style>p>a{}</style>\n   <div>last</div></body>',
]


FORMS = [
    ("<main>one<nav/>two <b>three</b></main>", "one\ntwo\nthree"),
    ("<main><div><header>x</div>kept</main>", "kept"),
    ("<main><nav>x<main>y</main>z</main>after", ""),
    ("<main>&#147;a&#148; &#146; &copy 2020 &amp b</main>", "\u201ca\u201d \u2019 \u00a9 2020 &amp; b".replace("&amp;", "&")),
    ("<main><p title=it's>alpha</p><p>beta</main>", "alpha\nbeta"),
    ("no element at <b>all", "no element at\nall"),
    ("<body><p>one<br>two<img src=x>three</body>", "one\ntwo\nthree"),
    ("<article/><body>b<article>a</article></body>", ""),
    (None, None),
    ("", ""),
]


@pytest.mark.parametrize("page, text", FORMS)
def test_pages_that_are_not_well_formed(spark, page, text):
    assert html.page_text(page) == text


def test_page_text_takes_linear_time():
    import time

    def seconds(n: int) -> float:
        page = "<body>" + "<div><nav>x<p>" * n + "</div>" * n + "y</body>"
        begin = time.perf_counter()
        assert html.page_text(page) == "y"
        return time.perf_counter() - begin

    seconds(1_000)
    assert seconds(40_000) < 10 * max(seconds(10_000), 0.02)


@pytest.mark.parametrize("page", PAGES)
def test_article_text(spark, page):
    got = spark.createDataFrame([(page,)], "c string").select(html.article_text(F.col("c"))).first()[0]
    assert got == python_article(page)


def test_article_text_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in pages.select("html", html.article_text(F.col("html")).alias("article")).collect():
        assert row["article"] == python_article(row["html"])


def test_contexts_of_dense_mentions(spark):
    """Contexts that reach over many neighbouring mentions, against slices of the text."""
    import random
    import re

    draw = random.Random(12)
    parts = ["1 case", "22 cases", "7 deaths", " ", "", "é", "\n", "word ", "a longer stretch of words between two of them, and more of it, "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(60))) for _ in range(80)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    rows = df.select("i", t.count_mentions(F.col("text")).alias("m")).collect()
    patterns = [r"(?i)(\d[\d,]*)\s+(?:confirmed\s+|suspected\s+)?cases?", r"(?i)(\d[\d,]*)\s+deaths?"]
    for r in rows:
        text = texts[r["i"]]
        want = [
            "..." + text[max(m.start() - 60, 0) : m.end() + 20].replace("\n", " ").strip() + "..."
            for pattern in patterns
            for m in re.finditer(pattern, text)
        ]
        assert [m["context"] for m in r["m"]] == want


def test_mentions_take_linear_time(spark):
    import time

    def seconds(n: int) -> float:
        df = spark.createDataFrame([("in all 12 cases were seen " * n,)], "text string")
        taken = []
        for _ in range(3):
            begin = time.perf_counter()
            assert len(df.select(F.size(t.count_mentions(F.col("text")))).collect()) == 1
            taken.append(time.perf_counter() - begin)
        return min(taken)

    seconds(2_000)
    assert seconds(80_000) < 10 * max(seconds(20_000), 0.1)


def test_a_large_gazetteer_drops_runs_inside_the_row(spark):
    """Names behind the filter: same places as a broadcast, and hardly a run that names nothing leaves its row."""
    names = spark.range(3000).selectExpr("concat('Zone_', id) AS name").union(spark.createDataFrame([("Mont Blanc",), ("",), ("Rio 5",)], "name string"))
    texts = spark.createDataFrame(
        [("A", " ".join(f"word{i}" for i in range(4000)) + " Zone_7 and Mont Blanc"), ("B", "Rio 5 Zone_2999 Zone_3000"), ("C", None), ("D", "nothing")],
        "bulletin string, text string",
    )
    want = {r[0]: r[1] for r in bulletins.locations(texts, names).collect()}
    assert want == {"A": ["Mont Blanc", "Zone_7"], "B": ["Rio 5", "Zone_2999"]}
    found = bulletins.locations(texts, names, broadcast_names=10)
    assert {r[0]: r[1] for r in found.collect()} == want
    told, _, runs = bulletins._names_and_runs(texts, names, 10)
    left = told.select(F.explode(runs)).count()
    assert 5 <= left < 5 + 8000 * 0.03
    records = [bulletins.extract(texts.where("text is not null"), names, n).orderBy("bulletin").collect() for n in (10, 10_000)]
    assert records[0] == records[1] and len(records[0]) == 3
