import json

from pyspark.sql import functions as F

from pagewright.__main__ import main
from pagewright.operators import tables_in_text
from pagewright.sources import records


def test_split_plan(spark, tmp_path):
    plan = {
        "stats": {"pdfs": {"a": {"status": "ok"}, "b": {"status": "error", "error": "broken"}}},
        "chunks": [{"path": f"x/a_{i}.pdf", "chunk_idx": i, "pages": 10 * i, "original_pdf": "in/a.pdf"} for i in (2, 1)],
        "direct": [{"pdf_path": "in/c.pdf", "pdf_name": None}],
    }
    (tmp_path / "plan.json").write_text(json.dumps(plan, indent=1))
    df = records.split_plan(spark, str(tmp_path / "plan.json"))
    got = {r.document: ([c.chunk_idx for c in r.chunks], r.pages) for r in records.planned_documents(df).collect()}
    assert got == {"a": ([1, 2], 30), "c": ([], None)}
    assert [tuple(r) for r in records.unsplit(df).collect()] == [("b", "broken")]


def test_yaml_records(spark, tmp_path):
    for name, text in (("d/d.validation.yaml", "kqi_metrics: {overall_quality_pass: false}"), ("e/e.validation.yaml", "kqi_metrics: ["), ("e/f/g.validation.yaml", "a: 1"), ("retry.yaml", "attempted_retries: 3\nskipped_pages: [{page: 1}]")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    got = {r.name: (r.kqi_metrics and r.kqi_metrics.overall_quality_pass, bool(r.error)) for r in records.validations(spark, str(tmp_path), "kqi_metrics struct<overall_quality_pass:boolean>").collect()}
    assert got == {"d": (False, False), "e": (None, True)}
    files = records.yaml_files(spark, str(tmp_path / "retry.yaml"))
    assert tuple(records.retries(files).first()) == (3, 0, 0, 1) and tuple(records.retries(files.limit(0)).first()) == (0, 0, 0, 0)
    names = spark.createDataFrame([("m_2024", "1"), ("m_2025", "2"), ("m_job7", "3")], "name string, data string")
    assert records.monitor_summary(names, "job7").first().data == "3" and records.monitor_summary(names.where("data < 3"), "job7").first().data == "2"


def test_events_are_added(spark, tmp_path):
    for n in (1, 2):
        records.append_events(spark.range(n), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 3


def test_table_sections(one):
    labels = one(tables_in_text.filtered_labels(F.array(*map(F.lit, ("Dose", "ab", "123", "Head", " title ", "a real one"))), F.array(F.lit("head")), F.lit("Title")))
    assert labels == ["a real one"]
    assert one(tables_in_text.with_tables(F.lit("text"), F.lit('{"figures": []}'))) == "text"
    bare = '[{"chart_identification": {"image_type": "table", "page_number": 1}}]'
    assert one(tables_in_text.with_tables(F.lit("text"), F.lit(bare))) == "text\n\n### Tabela\n"


def test_command_line(spark, tmp_path, sf_dir, capsys):
    (tmp_path / "a.md").write_text("# a\n\n## Page 1\n\ntext of a page\\nmore\n")
    main(["queries"], spark)
    assert "doc_quality_score" in capsys.readouterr().out
    main(["run", "split_guard", sf_dir, "--out", str(tmp_path / "out")], spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    main(["postprocess", str(tmp_path), "--out", str(tmp_path / "post")], spark)
    assert "page\nmore" in spark.read.parquet(str(tmp_path / "post")).first().text
    main(["validate", str(tmp_path)], spark)
    assert "# Quality report" in capsys.readouterr().out
    main(["clean", str(tmp_path), "--sheets"], spark)
    main(["sheets", str(tmp_path)], spark)
    assert "text of a page" in capsys.readouterr().out
