"""Null and repeated ids, table sizes and shapes for which an operator once did less than the whole job."""

from __future__ import annotations

from desklake.llm import decontaminate, jaccard_join, language_id, url_filter
from test_operators import LAST, PASSAGE, by_text, components_by_hand, rows_of


def test_clean_judges_rows_that_share_an_id_each_by_its_text(spark):
    rows = [(i, text) for i in (None, 7) for text in (PASSAGE + "tail", f"a clean text of {i}", "another clean text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = decontaminate.clean(docs, benchmark)
    assert by_text(rows_of(kept)) == by_text((i, text) for i, text in rows if not (text or "").startswith(PASSAGE))


def numbered(name, count):
    return " ".join(f"{name}{i}" for i in range(count))


def test_keep_one_tells_rows_with_null_and_repeated_ids_apart(spark):
    a, b, c, d = (numbered(name, 60) for name in "abcd")
    rows = [(1, a), (None, a + " x"), (None, "alone among all the others here"),    # near copy of 1; null id without a copy
            (None, b), (None, b + " x"), (None, b + " y"),                         # near copies without an id
            (2, c), (3, c + " x"), (3, "three stays by this other text of its own"),  # near copy under the id of a row that stays
            (4, d), (4, d + " x"), (5, d + " y"), (5, None), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = rows_of(jaccard_join.keep_one(docs, chunk_bytes=1000))
    alone = [rows[i] for i in (0, 2, 6, 8, 12, 13, 14)]
    assert all(row in kept for row in alone)
    rest = [row for row in kept if row not in alone]
    assert sorted((text[0], i is None) for i, text in rest) == [("b", True), ("d", False)] and (4, d) in rest or (4, d + " x") in rest
    assert len(kept) == 9


def test_no_language_pushes_another_out_of_the_sample(spark):
    words = {"de": "der hund und die katze sind nicht mehr hier", "en": "the dog and the cat are not here any more", "fr": "le chien et le chat ne sont plus ici"}
    rows = [(None, f"{words['de']} {i}", "de") for i in range(60)] + [(None, f"{words['de']} copy", "de")] * 60
    rows += [(9, f"{words['en']} {i}", "en") for i in range(60)] + [(9, f"{words['en']} copy", "en")] * 60
    rows += [(100 + i, f"{words['fr']} {i}", "fr") for i in range(10)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(labelled, most_docs=10)
    assert model.languages == ["de", "en", "fr"]
    told = language_id.predict(labelled, model).collect()
    assert sum(r["lang_pred"] == lang for r, (_, _, lang) in zip(told, rows)) >= 0.9 * len(rows)


def test_verdicts_do_not_depend_on_table_size_or_on_eight_links(spark):
    link = '<a href="{}/x?u=http://other.org/">x</a>'
    chain = [(i, f"http://h{i}.info/", link.format(f"{'' if i % 2 else 'HTTPS:'}//h{i + 1}.info" if i < 12 else "//bad.net")) for i in range(13)]
    mixed = [(19, "http://bad.net/", ""), (20, "http://two.info/block/", ""), (21, "http://two.info/", link.format("//friend.org"))]
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("block", "two.info", "/block/"), url_filter.Rule("allow", "org", "/")]
    small = spark.createDataFrame(chain + mixed, "page_id long, url string, html string")
    many = spark.range(3_000_000).selectExpr("1000 + id as page_id", "concat('http://n', id % 5, '.net/') as url", "'' as html")
    for pages in (small, small.unionByName(many)):
        got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, rules).where("page_id < 1000").collect()}
        assert got == {i: "block" for i, _, _ in chain + mixed}


def test_links_are_found_when_no_class_fits_the_centre_of_a_shingle(spark):
    short, passage = numbered("w", 12), numbered("p", 104)
    texts = [short, short.rsplit(" ", 1)[0], f"{short} {passage}", *[f"{passage} {numbered(name, 60)}" for name in "xyz"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(row) for row in jaccard_join.link_documents(docs).collect()]
    assert by_text(got) == by_text(components_by_hand(rows_of(docs)))
    assert (1, 7, 0) in got
