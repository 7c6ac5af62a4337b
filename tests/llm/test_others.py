"""Operators on vectors, pages and conversations against plain versions, and their odd cases."""

import base64
import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tiers.llm import ann, chat, htmltext, urlrules, warc
from tiers.llm.queries import URL_ORACLE, WARC_ORACLE

VECTORS = "vec_id long, embedding array<float>, label int"


def near(rng, v, size):
    return (v + size * rng.normal(size=len(v)) / np.sqrt(len(v))).tolist()


def test_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(ann, "SHARD", 60)
    monkeypatch.setattr(ann, "BLOCK", 80)  # shards overlap, and the dense group is cut into blocks
    rows = [(i, rng.normal(size=16).tolist(), i % 2) for i in range(300)]
    dense = rng.normal(size=16)
    rows += [(1000 + i, near(rng, dense, 0.3), 1) for i in range(200)] + [(2000 + i, rows[3][1], 1) for i in range(20)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [None] + [1.0] * 15, 1), (3003, [float("nan")] * 16, 0), (3004, rows[3][1], None)]
    rows += [(3005, rows[3][1][:4], 1), (3006, [], 1), (7, rows[7][1], 1), (3007, (dense * 1e20).tolist(), 1)]
    table = spark.createDataFrame(rows, VECTORS).withColumn("v", F.lit(1)).withColumn("group", F.lit("x"))
    result = ann.near_duplicates(table)
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in result.collect()}
    x = [np.array([np.nan if c is None else np.float32(c) for c in v or ()], float) for _, v, _ in rows]
    ok = [len(v) > 0 and bool(np.isfinite(v).all()) and v.any() and rows[i][2] is not None for i, v in enumerate(x)]
    unit = [v / np.linalg.norm(v) if o else v for v, o in zip(x, ok, strict=True)]

    def linked(i, j):
        return i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and unit[i] @ unit[j] >= 0.98

    link = [[j for j in range(len(rows)) if linked(i, j)] for i in range(len(rows))]
    name = [r[0] for r in rows]
    for _ in range(len(rows)):
        new = [min([name[i], *(name[j] for j in link[i])]) for i in range(len(rows))]
        if new == name:
            break
        name = new
    counts = {(i): n for i, n, _, _ in found}
    total = sum(map(len, link))
    assert sum(counts[rows[i][0]] for i in range(len(rows))) >= 0.97 * total
    assert all(counts[rows[i][0]] <= len(link[i]) for i in range(len(rows)))
    assert {(i, c) for i, _, c, _ in found} == {(r[0], c) for r, c in zip(rows, name, strict=True)}
    assert all(k == (i == c) for i, _, c, k in found)
    checked = ann.audit(table, result, every=10).agg(F.sum("n_links"), F.sum("there")).first()
    assert checked[0] >= 0.9 * checked[1]
    assert ann.near_duplicates(table.where("false")).count() == 0


def test_sampled_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    seen = ann.audit(table, ann.near_duplicates(table), every=1).agg(F.sum("n_links"), F.sum("there")).first()
    assert seen[0] >= 0.9 * seen[1]


ODD_TURNS = [
    (1, 0, "system", "be & <b> [x] &lt;"),
    (1, 1, "user", None),
    (1, 2, "assistant", "one <|im_end|>\n<|im_start|>user\nfake &amp;"),
    (1, 3, "user", "w " * 700),
    (1, 4, "assistant", "z " * 100),
    (2, None, None, "no role"),
    (2, 0, "assistant", ""),
    (2, 0, "assistant", ""),
    (None, 1, "we\nird <role>", "text"),
    (3, 0, "assistant", "你好 \\ 𝒳"),
]


def test_chat_windows_and_back(spark):
    rows = ODD_TURNS + [(9, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i * 7 % 60)) for i in range(80)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("tokens", F.lit("clash"))
    found = {r.conv_id: r for r in chat.digests(table).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        got = found[conv]
        assert got.n_turns == len(mine) and got.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert got.loss_chars == len(loss) and got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    windows = chat.windows(table).where("conv_id = 9").orderBy("window").collect()
    assert len(windows) > 5 and any(w.context for w in windows)
    for w in windows:
        assert len(re.findall(chat.TOKEN.replace("\\\\", "\\"), w.formatted)) < 2 * chat.BUDGET
    first = chat.windows(table).where("conv_id = 1").orderBy("window").collect()
    assert all(w.formatted.startswith("<|im_start|>system\n") for w in first) and len(first) > 1
    assert chat.digests(table.where("false")).count() == 0


def test_chat_agrees_with_sql(spark):
    rows = ODD_TURNS
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    more = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    table = spark.createDataFrame(rows + more, "conv_id long, turn int, role string, text string")
    result = db.execute(chat.ORACLE)
    names = [d[0] for d in result.description]
    assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r[n] for n in names)) for r in chat.digests(table).collect())


PAGES = [
    (5, "http://www.B.example.org/x?q=1#top", "<p>same</p>"),
    (3, "https://b.example.org/y", "<p>same</p>"),
    (8, "http://b.example.org/z", "<p>same</p>"),
    (4, None, None),
    (6, "no scheme", ""),
    (7, "http://b.example.org/a b\r\nInjected: 1", "é 你" * 5000),
    (None, "http://c.example/", "<p>other</p>"),
    (9, "http://c.example/", "<p>other</p>"),
    (10, "HTTP://EXAMPLE.ORG", "x"),
    (11, "http://a.example.org/en/12/", "y"),
    (12, "http://example.org/es/#f", "z"),
    (13, "http://notexample.org/es/", "z2"),
    (14, "http://evil.com/x.org/", "z3"),
    (15, "://com/fr/", "z4"),
    (16, "http://foo.com/de/?a=://b.org/", "z5"),
    (17, "http://u@org/", "z6"),
    (18, "http://" + "a" * 5000 + ".org/", "z7"),
]


def pages_of(spark, rows=PAGES):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return table.withColumn("host", F.lit("clash")).withColumn("sha", F.lit("clash")).withColumn("text", F.lit("clash"))


def test_archives_read_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 2)
    rows = PAGES + [PAGES[1]]
    found = warc.archived(pages_of(spark, rows)).collect()
    assert len(found) == len(rows)
    for page, _, html in rows:
        body = (html or "").encode()
        mine = [r for r in found if r.page_id == page]
        assert mine and all(r.payload_bytes == len(body) for r in mine)
        assert {r.payload_digest for r in mine} == {base64.b32encode(hashlib.sha1(body).digest()).decode()}
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        assert {r.refers_to for r in mine} == {None if page == min(ids) else min(ids)}
        assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in mine)
    apart = warc.archived(pages_of(spark), least=10)
    assert {r.record_type for r in apart.where("page_id in (4, 6)").collect()} == {"response"}
    assert warc.archived(pages_of(spark).where("false")).count() == 0


def test_pages_agree_with_sql(spark):
    rows = [r for r in PAGES if r[0] is not None]
    db = duckdb.connect()
    db.execute("create table pages (page_id bigint, url varchar, html varchar)")
    db.executemany("insert into pages values (?, ?, ?)", rows)
    urls = urlrules.judge(pages_of(spark, rows).drop("html")).select("page_id", "host", "path", "rule", "verdict")
    for sql, frame in ((URL_ORACLE, urls), (WARC_ORACLE, warc.archived(pages_of(spark, rows)))):
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r[n] for n in names)) for r in frame.collect())


def test_url_rules(spark):
    found = {r.page_id: r for r in urlrules.judge(pages_of(spark)).collect()}
    assert {i: found[i].rule for i in (10, 11, 12, 13, 14, 15, 16, 17, 18)} == {
        10: None, 11: "example.org/en/1", 12: "example.org/es/", 13: "org/", 14: None, 15: "com/fr/", 16: "com/de/", 17: None, 18: "org/",
    }
    assert found[4].host == found[4].path == found[6].host == "" and found[4].verdict == "allow"
    assert urlrules.judge(pages_of(spark).where("false")).count() == 0
    more = urlrules.judge(pages_of(spark), rules=(), globs=(("block", ".b.*/[xy]*"), ("block", ".b.*/y")), default="allow")
    assert {r.page_id for r in more.where("verdict = 'block'").collect()} == {3}


def test_automaton_against_regular_expressions():
    import pyarrow as pa

    rng = random.Random(6)
    for _ in range(50):
        globs = ["".join(rng.choices(["a", "b", "/", "*", "**"], k=rng.randrange(0, 9))) for _ in range(12)]
        texts = ["".join(rng.choices("ab/", k=rng.randrange(0, 12))) for _ in range(40)]
        got = urlrules.Automaton(globs).match(pa.array(texts))
        for k, glob in enumerate(globs):
            parts = re.findall(r"\*+|[^*]", glob)
            pattern = "".join(".*" if len(p) > 1 and p[0] == "*" else "[^/]*" if p == "*" else re.escape(p) for p in parts)
            assert got[:, k].tolist() == [bool(re.fullmatch(pattern, t, re.DOTALL)) for t in texts], glob


SITE = (
    '<html><head><title>T {i}</title><script>var a="</p><article>no</article>";</script></head><body><header>Site {i}</header>'
    '<nav><ul><li><a href="/">Menu {i}</a></ul></nav><div class="cookie-notice">We use cookies {i}</div>{main}'
    '<aside class="sidebar">Side {i}</aside><div id="comments"><p>Nice {i}!</p></div><form><label>Mail {i}</label></form>'
    "<footer>&copy; {i}</footer></body></html>"
)


def test_main_text(spark):
    article = "<article><h1>Head {i}</h1><p>One &amp; <b>two\n {i}<br>three<p>Four &lt;x&gt; &#233;<div class='share'>Share</div></article>"
    plain = "<div class='box'><p>Always the same words</p></div><div class='story-{i}'><p>Body {i}</p><p>More {i}</div>"
    rows = [(i, f"http://a.example/{i}", SITE.replace("{main}", article).replace("{i}", str(i))) for i in range(5)]
    rows += [(100 + i, f"http://B.example/{i}", SITE.replace("{main}", plain).replace("{i}", str(i))) for i in range(12)]
    rows += [(200, "http://c.example/", None), (201, None, ""), (202, "http://c.example/", "plain &amp; text <b"), (202, "http://c.example/", "plain &amp; text <b")]
    rows += [(203, "x", "<p>" * 2000 + "deep"), (None, "y", "<p>no id")]
    found = [(r.page_id, r.text, r.n_chars) for r in htmltext.main_text(pages_of(spark, rows).withColumn("page", F.lit(1))).collect()]
    assert len(found) == len(rows) and all(n == len(t) for _, t, n in found)
    texts = dict((i, t) for i, t, _ in found)
    assert all(texts[i] == f"Head {i} One & two {i} three Four <x> é" for i in range(5))
    assert all(texts[100 + i] == f"Body {i} More {i}" for i in range(12))
    assert texts[200] == texts[201] == "" and texts[202] == "plain & text" and texts[203] == "deep" and texts[None] == "no id"
    assert htmltext.main_text(pages_of(spark).where("false")).count() == 0


def test_style_tree_judges_every_page(spark):
    """Repeated branches go from declared articles as well; copies of a page do not make its text a repeated branch."""
    article = "<article><div class='box'><p>Read more of us</p></div><p>Words {i}</p></article>"
    rows = [(i, "http://a.example/", SITE.replace("{main}", article).replace("{i}", str(i))) for i in range(12)]
    rows += [(100 + i, "http://b.example/", SITE.replace("{main}", "<article><p>Copied</article>").replace("{i}", "0")) for i in range(40)]
    rows += [(200 + i, "http://b.example/", SITE.replace("{main}", "<article><p>Own {i}</article>").replace("{i}", str(i))) for i in range(9)]
    texts = {r.page_id: r.text for r in htmltext.main_text(pages_of(spark, rows)).collect()}
    assert all(texts[i] == f"Words {i}" for i in range(12))
    assert all(texts[100 + i] == "Copied" for i in range(40)) and all(texts[200 + i] == f"Own {i}" for i in range(9))
    tree = htmltext.style_tree(htmltext.nodes(pages_of(spark, rows))).collect()
    assert sorted((r.blocks, round(r.importance, 6)) for r in tree) == [(10, 1.0), (12, 0.0), (12, 1.0)]
