from pyspark.sql import functions as F

from pagewright.functions import llm_json as L
from pagewright.functions import markdown as M

MD = "# Doc\n\n## Page 2\nb\n\n## Page 1\na [Page 1] ![x](images/page_007.png) [l](yaml_metadata/F_1_page9.yaml)\n\n## Page 2\nb2\n"


def test_page_order_and_offset(one):
    assert one(M.fix_page_order(F.lit(MD))).startswith("# Doc\n\n## Page 1\na") and one(M.fix_page_order(F.lit(MD))).endswith("## Page 2\nb2\n")
    moved = one(M.apply_page_offset(F.lit(MD), F.lit(10)))
    assert all(x in moved for x in ("## Page 12", "## Page 11", "[Page 11]", "images/page_017.png", "F_1_page19.yaml"))
    assert one(M.apply_page_offset(F.lit(MD), F.lit(0))) == MD


def test_tables(one):
    table = "t\n|a|bbbb|\n|-|:-:|\n|1|2|\n|333333|\nend"
    want = "t\n| a      | bbbb |\n| ------ | :--: |\n| 1      | 2    |\n| 333333 |      |\nend"
    assert one(M.fix_tables(F.lit(table))) == want
    # A rule with spaces begins no table, so aligned ones stay as they are.
    assert one(M.fix_tables(F.lit("| a |\n| - |\n| 1 |"))) == "| a |\n| - |\n| 1 |"
    rows = F.array(F.lit("|h|k|"), F.lit("|-|-|"), F.lit("|1|2|"))
    assert one(M.table_records(rows)) == [{"h": "1", "k": "2"}]


def test_json_removal():
    assert M.drop_json('a\n```json\n{"body_text": "x\\\\ny"}\n```\nb') == ("a\nx\ny\nb", 1)
    assert M.drop_json("a\n```json\n{broken\n```\nb") == ("a\n```json\n{broken\n```\nb", 0)
    assert M.drop_json('a\n```json\n[1]\n```\nb') == ("a\n\nb", 1)
    opened = '## Page 1\n```json\n{\n  "page_number": 1,\n  "body_text": "some text",\n  "x": 1\n\n## Page 2\nz'
    assert M.drop_json(opened) == ("## Page 1\nsome text\n\n## Page 2\nz", 1)
    assert M.drop_json('"tables": [],\nkept') == ("kept", 1)
    assert M.drop_json('"body_text": "one\ntwo",\n## Page 2') == ("one\ntwo\n## Page 2", 1)


def test_newlines_and_warnings(one):
    assert one(M.fix_newlines(F.lit("a\\nb ```c\\nd``` e\\nf $$g\\nh$$ i\\n"))) == "a\nb ```c\\nd``` e\nf $$g\\nh$$ i\n"
    assert one(M.merge_empty_lines(F.lit("a\n\n\n\n\nb"))) == "a\n\n\nb"
    assert one(M.heading_warnings(F.lit("# a\n### b\nx"))) == ["line 1: empty heading", "line 2: level jumps from 1 to 3"]
    spans = [one(M.latex_problem(F.lit(x))) for x in ("{a}", "{a)", "(a", "\\frac ", "x")]
    assert spans == [None, "mismatched", "unclosed", "incomplete frac", None]
    assert one(M.broken_links(F.lit("# A b\n[x](#a-b) [y](#c)"))) == ["c"]
    assert one(M.toc(F.lit("# T\n## A b\n### C!"))) == "## Contents\n\n- [A b](#a-b)\n  - [C!](#c)\n\n---\n"


def test_json_parts(one):
    assert one(L.json_part(F.lit('x ```json\n{"a": 1}\n``` y'))) == '{"a": 1}'
    assert one(L.json_part(F.lit('x {"a": {"b": 1}} y'))) == '{"a": {"b": 1}}'
    assert one(L.json_part(F.lit("none"))) == "none"
    assert one(L.fix_escapes(F.lit('\\frac \\alpha \\n \\" \\\\ \\u00e9 \\u00'))) == '\\\\frac \\\\alpha \\n \\" \\\\ \\u00e9 \\\\u00'
    page = one(L.parsed_page(F.lit('```json\n{"page_number": 3, "body_text": "\\alpha", "formulas": ["a"]}\n```')))
    assert (page.page_number, page.body_text, page.formulas) == (3, "\\alpha", ["a"])


def test_salvage(one):
    assert L.salvage('{"page_number": 1, "body_text": "cut of', 1) == {"page_number": 1, "body_text": "cut of"}
    assert L.salvage('{"a": [1, {"body_text": "' + "word " * 40, 2)["body_text"].startswith("word word")
    assert one(L.page_text(F.lit('{"page_number": 1, "body_text": "' + "long " * 30), F.lit(1))).startswith("long long")
    assert one(L.level_value(F.lit("odd"))) == 0.6 and one(L.level_value(F.lit("HIGH"), L.META_CONFIDENCE)) == 0.95
