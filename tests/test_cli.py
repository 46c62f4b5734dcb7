"""The commands on small folders."""

import json

from paperloom import cli


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def printed(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


MD = "## A title\n\nA. Doe, B. Roe*\n\nDepartment of X\n\n" + "Long abstract sentence here. " * 8 + "\n\n## 1. Introduction\n\nSee [1] and $x$ and ν.\n\n<!-- formula-slot:p1:1:0:0:0:0 -->\n\n## References\n\n[1] A. Doe, Nano Lett. 2020, 1, 2.\n"


def test_scores_and_latex(spark, tmp_path, capsys):
    put(tmp_path / "in/p.md", MD)
    assert cli.main(["--json", "score", str(tmp_path / "in"), "--elapsed", "10", "--save", str(tmp_path / "scores")], spark) == 0
    got = printed(capsys)
    assert got[0]["doc_id"] == "p" and got[0]["speed"] == 5.0 and got[0]["total"] == got[0]["subtotal"] + 5
    assert cli.main(["--json", "score", str(tmp_path / "in"), "--quick"], spark) == 0 and printed(capsys)[0]["total"] > 0
    assert cli.main(["latex", str(tmp_path / "in"), str(tmp_path / "tex")], spark) == 0
    assert sorted(x.name for x in (tmp_path / "tex/p").iterdir() if not x.name.startswith(".")) == ["references.bib", "submission.tex"]
    assert cli.main(["latex", str(tmp_path / "in"), str(tmp_path / "rows"), "--rows"], spark) == 0
    r = spark.read.parquet(str(tmp_path / "rows")).collect()[0]
    assert (tmp_path / "tex/p/submission.tex").read_text() == r.tex and (tmp_path / "tex/p/references.bib").read_text() == r.bib
    assert r.tex.startswith("\\documentclass") and "\\cite{Doe2020}" in r.tex and "\\section{Introduction}" in r.tex and "@article{Doe2020" in r.bib


def test_paper(spark, tmp_path):
    put(tmp_path / "in/p.md", MD)
    put(tmp_path / "f.json", json.dumps([{"doc_id": "p", "pos": 0, "page": 1, "type": "display", "score": 0.9, "poly": [0, 0, 1, 1], "latex": "E = m"}]))
    assert cli.main(["paper", str(tmp_path / "in"), str(tmp_path / "f.json"), str(tmp_path / "out")], spark) == 0
    md = spark.read.parquet(str(tmp_path / "out")).collect()[0].md
    assert md.startswith('---\ntitle: "A title"') and "$$\nE = m\n$$" in md and "\nDepartment of X\n\n" not in md.split("---\n", 2)[2]


def test_learning(spark, tmp_path, capsys):
    for i in range(3):
        put(tmp_path / f"a/p{i}.md", "one\n© F\ntwo\n")
        put(tmp_path / f"b/p{i}.md", "one\ntwo\n")
    put(tmp_path / "params.json", json.dumps([{"journal": "j", "mfd_conf_override": 0.4}]))
    assert cli.main(["--json", "track", str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "log"), "--journal", "j"], spark) == 0
    assert sum(r["boilerplate_removal"] for r in printed(capsys)) == 3
    assert cli.main(["--json", "learn", str(tmp_path / "log"), str(tmp_path / "params.json"), "--apply", str(tmp_path / "new")], spark) == 0
    got = printed(capsys)
    assert [(r["param"], r["n"], r["papers"]) for r in got] == [("extra_boilerplate_patterns", 1, ["p0", "p1", "p2"])]
    stored = spark.read.schema(cli.PARAMS).json(str(tmp_path / "new")).collect()[0]
    assert stored.extra_boilerplate_patterns == ["© F"] and stored.mfd_conf_override == 0.4 and len(stored.history) == 1


def test_guard_and_word(spark, tmp_path):
    put(tmp_path / "s.json", json.dumps([{"paper_key": "p", "key_name": "e/p", "total": 80.0}]))
    put(tmp_path / "t.json", json.dumps([{"paper_key": "p", "key_name": "e/p", "total": 70.0}]))
    put(tmp_path / "pr.json", json.dumps([{"pid": "j", "known_papers": ["p"]}]))
    assert cli.main(["guard", str(tmp_path / "s.json"), "--freeze", str(tmp_path / "base")], spark) == 0
    check = lambda s: cli.main(["guard", str(tmp_path / s), "--check", "j", "--baseline", str(tmp_path / "base"), "--profiles", str(tmp_path / "pr.json")], spark)
    assert check("s.json") == 0 and check("t.json") == 1
    put(tmp_path / "w/d.md", "x\n| a |\n|---|\n| 1 |\n\ny\n")
    put(tmp_path / "tables.json", json.dumps([{"doc_id": "d", "pos": 0, "first_row": [["Name"]]}]))
    assert cli.main(["word", str(tmp_path / "w"), str(tmp_path / "tables.json"), str(tmp_path / "out")], spark) == 0
    assert "| Name |\n| ---- |\n|      |" in spark.read.parquet(str(tmp_path / "out")).collect()[0].md
