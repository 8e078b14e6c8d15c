"""Repeated 3-word windows that overlap, in texts of four and five words."""

from geoloom.llm import quality_rules


def test_overlapping_windows_of_short_texts(spark):
    texts = {"a a a": 0, "a a a a": 4, "a b a b": 0, "a b a b a": 5, "a a a a b": 4, "a b c d e": 0, "": 0}
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    found = quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {texts_of: r for texts_of, r in ((rows[x.doc_id][1], x.n_repeat_words) for x in found)} == texts
