"""Commands over small folders, one after another."""

import json

import pytest

from lexaloom.cli import main


def read(spark, path):
    return spark.read.json(str(path)).collect()


def test_chunk_condense_upload(spark, tmp_path):
    structure = {"topics": [{"title": "Part", "children": [{"title": "Intro", "source_sections": ["Chapter 1: Start"], "split_after_headings": ["Two"]}, {"title": "More"}]}, {"title": "End", "source_sections": "lone"}]}
    (tmp_path / "structure.json").write_text(json.dumps(structure))
    (tmp_path / "in").mkdir()
    sections = [{"title": "Chapter 1: Start", "content": "one two", "depth": 0, "images": [{"id": "i", "local_path": "a.png"}]}, {"title": "more", "content": "three"}, {"title": "Cover", "content": "x"}]
    (tmp_path / "in" / "a.json").write_text(json.dumps({"source_type": "pdf", "source_path": "a.pdf", "sections": sections}))
    main(["chunk", "--structure", str(tmp_path / "structure.json"), "--extracted", str(tmp_path / "in"), "-o", str(tmp_path / "chunks")], spark)
    got = {tuple(r.topic_path): (r.content, r.source, r.token_count) for r in read(spark, tmp_path / "chunks")}
    assert got == {("Part", "Intro"): ("one two", "a.pdf", 2), ("Part", "More"): ("three", "a.pdf", 1)}
    (tmp_path / "remap.json").write_text(json.dumps({"more": "Much more", "a.json": {"more": "For a"}}))
    main(["normalize", str(tmp_path / "in"), "--remap", str(tmp_path / "remap.json"), "-o", str(tmp_path / "norm")], spark)
    assert sorted(r.title for r in read(spark, tmp_path / "norm")) == ["For a", "Start"]
    plan = [{"tier": "core", "topic_ord": 0, "title": "Intro", "condensation_strategy": "keep"}, {"tier": "classic", "topic_ord": 0, "title": "All", "condensation_strategy": "merge", "source_topics": ["More", "Intro"]}]
    (tmp_path / "plan.json").write_text(json.dumps(plan))
    main(["condense", "--plan", str(tmp_path / "plan.json"), "--chunks", str(tmp_path / "chunks"), "-o", str(tmp_path / "tiers")], spark)
    assert {(r.tier, r.content) for r in read(spark, tmp_path / "tiers" / "chunks")} == {("core", "one two"), ("classic", "three\n\none two")}
    args = ["upload", "--structure", str(tmp_path / "structure.json"), "--chunks", str(tmp_path / "chunks"), "--domain", "d", "--images", "https://i.example"]
    main([*args, "-o", str(tmp_path / "db")], spark)
    rows = read(spark, tmp_path / "db" / "content_chunks")
    assert sorted(r.content for r in rows) == ["one two", "three"] and len(read(spark, tmp_path / "db" / "topics")) == 4
    assert json.loads(next(r.metadata for r in rows if r.content == "one two"))["images"][0]["url"] == "https://i.example/a.png"
    main([*args, "--update", str(tmp_path / "db" / "content_chunks"), "-o", str(tmp_path / "db2")], spark)
    assert len(read(spark, tmp_path / "db2" / "content_chunks")) == 2  # nothing is stored twice
    main([*args, "--update", str(tmp_path / "db" / "content_chunks"), "--replace-chunks", "-o", str(tmp_path / "db3")], spark)
    assert len(read(spark, tmp_path / "db3" / "content_chunks")) == 2
    with pytest.raises(SystemExit):
        main([*args, "--replace-chunks"], spark)


def test_extract_tree_images_migrations(spark, tmp_path, capsys):
    (tmp_path / "code" / "src").mkdir(parents=True)
    (tmp_path / "code" / "README.md").write_text("read me")
    (tmp_path / "code" / "src" / "a.py").write_text("x = 1")
    main(["extract", "code", str(tmp_path / "code"), "-o", str(tmp_path / "o1")], spark)
    assert [r.title for r in sorted(read(spark, tmp_path / "o1"), key=lambda r: r.section_ord)] == ["README", "File Structure", "src"]
    (tmp_path / "t.csv").write_text("a;b\n1;x|y\n2;z\n")
    main(["extract", "tabular", str(tmp_path / "t.csv"), "-o", str(tmp_path / "o2")], spark)
    assert "| 1 | x\\|y |" in read(spark, tmp_path / "o2")[0].content
    (tmp_path / "w.json").write_text(json.dumps({"url": "https://a.example/x", "html": "<title>T</title><meta name='author' content='Me'><p>hello</p>"}))
    main(["extract", "web", str(tmp_path / "w.json"), "-o", str(tmp_path / "o3")], spark)
    assert [(r.title, r.author) for r in read(spark, tmp_path / "o3")] == [("T", "Me")]
    (tmp_path / "p.json").write_text("\n".join(json.dumps({"doc": "d", "page": i, "text": f"Chapter {i}: Name {i}\ntext"}) for i in range(1, 23)))
    main(["tree", str(tmp_path / "p.json"), "-o", str(tmp_path / "o4")], spark)
    assert len(read(spark, tmp_path / "o4")) == 22
    (tmp_path / "r.json").write_text(json.dumps({"source": "s", "id": "i", "local_path": "a.png"}))
    (tmp_path / "f.json").write_text(json.dumps({"local_path": "a.png"}))
    main(["images", "prepare", str(tmp_path / "r.json"), str(tmp_path / "f.json"), "-o", str(tmp_path / "o5")], spark)
    assert read(spark, tmp_path / "o5")[0].file_exists
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "001_a.sql").write_text("select 1")
    main(["migrations", str(tmp_path / "m")], spark)
    assert "001_a.sql" in capsys.readouterr().out
