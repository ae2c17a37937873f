"""Documents as VARIANT: types as they are, texts that are no JSON, missing fields."""

from silverline.sources import variants as V


def written(tmp_path, *lines):
    (tmp_path / "lines.json").write_text("\n".join(lines))
    return str(tmp_path)


def test_types_stay_as_they_are(spark, tmp_path):
    path = written(tmp_path, '{"id": 1, "t": 5, "tags": ["a", 2]}', '{"id": 2, "t": "7", "tags": null}', "", "   ", "{bad", '{"id": 3, "t": {"amount": 9}}', "[1]", '{"t": 1.5}')
    d = V.read_variants(spark, path)
    assert sorted(r.bad for r in d.filter("bad is not null").collect()) == ["{bad"] and d.count() == 6
    got = d.filter("bad is null").select(V.field("document", "$.id", "bigint").alias("id"), V.kind("document", "$.t").alias("kind"), V.field("document", "$.t", "bigint").alias("t"),
                                         V.field("document", "$.t.amount", "int").alias("amount")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "BIGINT", 5, None), (2, "STRING", 7, None), (3, "OBJECT", None, 9), (None, None, None, None), (None, "DECIMAL", 1, None)], key=str)
    types = {(r.field, r.kind): (r.n_rows, r.conflict) for r in V.field_types(d, "document").collect()}
    assert types == {("id", "BIGINT"): (3, False), ("t", "BIGINT"): (1, True), ("t", "STRING"): (1, True), ("t", "OBJECT"): (1, True), ("t", "DECIMAL"): (1, True),
                     ("tags", "ARRAY"): (1, False), ("tags", "VOID"): (1, False)}
    assert V.merged_schema(d.filter("bad is null").filter(V.field("document", "$.id", "int") < 3), "document").startswith("OBJECT<id: BIGINT, t: VARIANT")


def test_records_and_whole_documents(spark, tmp_path):
    path = written(tmp_path, '{"a": {"items": [{"x": 1},', ' {"x": "two"}, 3]}}')
    d = V.read_variants(spark, path, whole=True)
    rows = V.records(d, "document", "$.a.items").select("place", V.field("record", "$.x", "string").alias("x"), V.kind("record").alias("kind")).collect()
    assert [tuple(r) for r in rows] == [(0, "1", "OBJECT"), (1, "two", "OBJECT"), (2, None, "BIGINT")]
    assert [tuple(r) for r in V.records(d, "document", "$.a").select("place").collect()] == [(None,)]
    assert V.field_types(d.limit(0), "document").count() == 0
