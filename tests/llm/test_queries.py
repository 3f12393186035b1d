import os

import pytest

from loomline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["collection", "cutoff_milli", "kept"], "p2_found": ["id"], "p3_found": ["id"], "p4_found": ["id", "pii_type", "pii_text"], "p5_found": ["id", "line_no"],
    "p6_found": ["id", "line_no", "lang"], "p7_found": ["id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "subject"],
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name]
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert len(set(rows)) == len(rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    from tests.oracle import compare

    assert compare(spark, SF, QUERIES[name](spark, SF), ORACLE[name]) == ""


def test_models_are_saved_and_used_again(spark, tmp_path):
    from loomline.llm import boilerplate, pages

    texts = [f"Home | Shop\nThe old garden gate {k} was open when we came home." for k in range(40)]
    body = boilerplate.train(texts, [["Navigation & Interface Elements", "Clean"]] * 40)
    pages.save_model(spark, body, str(tmp_path / "body"))
    again = pages.load_model(spark, str(tmp_path / "body"))
    assert (again.mark(boilerplate.Pages(texts)) == body.mark(boilerplate.Pages(texts))).all()
