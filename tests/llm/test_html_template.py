"""The template decides: against a brute-force deduction on small hosts, and with every telling name taken away."""

import random

from pyspark.sql import functions as F

from lakecare.llm import html_extract as html

SMALL = "/root/testdata/sf0.01"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(count))


def page(i, share=True, comments=0):
    remarks = "".join(f"<p>remark {i} {k}</p>" for k in range(comments))
    return (
        f"<html><body><div><a href='/{i}'>{prose(i + 900, 6)}</a></div><div>{prose(i + 500, 4)}</div>"
        f"<div><h1>Title {i}</h1><p>{prose(i, 60)}</p>{'<div><p>Tell your friends</p></div>' if share else ''}<p>{prose(i + 100, 40)}</p></div>"
        f"<div class='comments'>{remarks}</div><div>All rights reserved</div></body></html>"
    )


def wanted(i):
    return f"Title {i}\n\n{prose(i, 60)}\n\n{prose(i + 100, 40)}"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def brute(sources):
    """Template, fixed tokens and main element of one host by plain counting over all its pages together."""
    read = [html.read_page(s) for s in sources]
    on = {}
    for k, p in enumerate(read):
        for t in p.tokens:
            on.setdefault(t, {}).setdefault(k, 0)
            on[t][k] += 1
    frequent = {t for t, at in on.items() if len(at) >= 3 and len(at) >= len(read) / 2}
    vectors = {t: tuple(sorted(on[t].items())) for t in frequent}
    names = {v: n for n, v in enumerate(sorted(set(vectors.values())))}
    held, depth, total = {}, {}, 0
    for p in read:
        for b in p.blocks:
            if b.token in frequent or b.excluded:
                continue
            total += b.size
            for d, t in enumerate(b.chain):
                held[t] = held.get(t, 0) + b.size
                depth[t] = max(d, depth.get(t, 0))
    most = [t for t in held if t in frequent and held[t] > total / 2]
    fixed = frozenset(t for t in frequent if len(on[t]) >= 5 and len(on[t]) >= 0.9 * len(read))
    return html.Template({t: names[v] for t, v in vectors.items()}, fixed, max(most, key=depth.get) if most else None)


def test_template_against_brute_force(spark):
    rows = [(i, f"http://a.example/{i}", page(i, i % 4 > 0, i % 3)) for i in range(12)]
    rows += [(i, f"http://b.example/{i}", page(i, True, 2)) for i in range(20, 23)]
    rows += [(i, f"http://c.example/{i}", page(i)) for i in range(30, 32)]
    found = {r["page_id"]: r["text"] for r in html.extract(pages(spark, rows)).collect()}
    for host in "abc":
        own = [r for r in rows if f"//{host}." in r[1]]
        template = brute([r[2] for r in own])
        for i, _, source in own:
            assert found[i] == html.article_text(html.read_page(source), template if len(own) >= 3 else html.Template())


def test_the_slot_of_varying_text_is_the_article(spark):
    rows = [(i, f"http://a.example/{i}", page(i, True, i % 3)) for i in range(10)]
    found = {r["page_id"]: r["text"] for r in html.extract(pages(spark, rows)).collect()}
    assert all(found[i] == wanted(i) for i in range(10))
    for i, _, source in rows:  # without the template, links, notices and prompts come along
        emptied = html.article_text(html.read_page(source), html.Template())
        assert emptied != wanted(i) and "Tell your friends" in emptied and "All rights reserved" in emptied


def test_a_line_that_all_articles_share_stays(spark):
    rows = [(i, f"http://a.example/{i}", page(i, False).replace("<h1>", "<p>Our daily motto</p><h1>")) for i in range(8)]
    found = {r["page_id"]: r["text"] for r in html.extract(pages(spark, rows)).collect()}
    assert all(found[i] == f"Our daily motto\n\n{wanted(i)}" for i in range(8))


def test_equal_pages_and_pages_of_another_form(spark):
    rows = [(i, "http://a.example/x", page(1, False)) for i in range(6)] + [(i, f"http://a.example/{i}", page(i, False)) for i in range(10, 16)]
    rows += [(99, "http://a.example/odd", "<p>quite another page</p>"), (98, "http://a.example/none", None)]
    found = {r["page_id"]: r["text"] for r in html.extract(pages(spark, rows)).collect()}
    assert {found[i] for i in range(6)} == {wanted(1)} and all(found[i] == wanted(i) for i in range(10, 16))
    assert found[99] == "quite another page" and found[98] == ""


def test_very_long_pages_are_read_whole(spark):
    long = [(i, f"http://a.example/{i}", page(i, False).replace("<h1>", "<p>" + prose(i, 30000) + "</p><h1>")) for i in range(4)]
    found = {r["page_id"]: r["text"] for r in html.extract(pages(spark, long)).collect()}
    assert all(found[i] == f"{prose(i, 30000)}\n\n{wanted(i)}" for i in range(4))


def test_articles_are_found_without_any_telling_tag_or_name(spark):
    given = spark.read.parquet(f"{SMALL}/pages.parquet")
    truth = {r["page_id"]: r["text"] for r in html.extract(given).collect()}
    told = F.regexp_replace("html", r"(?i)<(/?)(article|main|nav|aside|footer|header)\b", "<$1div")
    bare = given.withColumn("html", F.regexp_replace(told, r"(?i) (class|id|role)=(\"[^\"]*\"|'[^']*')", ""))
    hosts = {}
    for r in given.select("page_id", "url").collect():
        hosts.setdefault(r["url"].split("/")[2], []).append(r["page_id"])
    many = [p for own in hosts.values() if len(own) >= 3 for p in own]
    found = {r["page_id"]: r["text"] for r in html.extract(bare).collect()}
    emptied = {r["page_id"]: html.article_text(html.read_page(r["html"]), html.Template()) for r in bare.collect()}
    assert len(many) > 200
    assert sum(found[p] == truth[p] for p in many) >= 0.98 * len(many)
    assert sum(emptied[p] == truth[p] for p in many) <= 0.02 * len(many)
