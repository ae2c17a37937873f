"""UDF-3: extractors as table functions of SQL."""

import pytest

from silverline.operators import extractors


def test_lateral_calls(spark):
    extractors.register_extractors(spark)
    spark.createDataFrame([(1, '{"a":1} x {"b":{}}'), (2, "none"), (3, None)], "id int, text string").createOrReplaceTempView("texts_of_extractors")
    inner = spark.sql("select id, obj_idx, json from texts_of_extractors, lateral json_objects(text) order by id, obj_idx").collect()
    assert [tuple(r) for r in inner] == [(1, 0, '{"a":1}'), (1, 1, '{"b":{}}')]
    outer = spark.sql("select id, count(json) as n, count(*) as rows from texts_of_extractors, lateral json_objects_outer(text) group by id order by id").collect()
    assert [tuple(r) for r in outer] == [(1, 2, 2), (2, 0, 1), (3, 0, 1)]


def test_own_extractor_with_an_option_and_an_error(spark):
    def words(text, least):
        if text == "bad":
            raise ValueError("cannot read this one")
        return ((w, len(w)) for w in text.split() if len(w) >= least)

    extractors.register_extractor(spark, "long_words", words, "word string, size int")
    got = spark.sql("select word, size from values ('a bcd ef'), (null), ('') t(text), lateral long_words(text, 2)").collect()
    assert sorted(map(tuple, got)) == [("bcd", 3), ("ef", 2)]
    with pytest.raises(Exception, match="cannot read this one"):
        spark.sql("select * from long_words('bad', 1)").collect()
