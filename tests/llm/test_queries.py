import pytest

from quillspark.llm import queries

COLUMNS = {
    "p1_found": ["poem_a", "poem_b"], "p2_found": ["name_a", "name_b"], "p3_found": ["poem_no", "line_id"], "p4_found": ["poem_no", "group_no"], "p5_found": ["group_no", "title_copy", "year_copy", "body_copy"],
    "p6_found": ["poem_no", "line_id"], "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_no_repeats(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    assert df.columns == COLUMNS[name]
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert rows and len(rows) == len(set(rows))
