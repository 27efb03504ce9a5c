"""Sentence units in several scripts."""

from lexaloom.llm import sentences

MODEL = [("abbr", a) for a in ("dr", "fig", "etc", "e.g", "z", "ص")] + [("start", s) for s in ("the", "each", "der")]


def units(text, model=MODEL):
    return [text[a:b] for a, b in sentences.Splitter(model).units(text)]


def test_periods():
    assert units("Dr. Xo sees Fig. 3. The end, etc. The rest waits ... and goes. Visit a.b.c/d.html now!") == ["Dr. Xo sees Fig. 3.", "The end, etc.", "The rest waits ... and goes.", "Visit a.b.c/d.html now!"]
    assert units("Es sind 3.5 m, z. B. hier. Im 19. Kapitel endet es.La casa") == ["Es sind 3.5 m, z. B. hier.", "Im 19. Kapitel endet es.", "La casa"]
    assert units("It ends.[12] The next.") == ["It ends.[12]", "The next."]


def test_quotes():
    assert units('"Is it ready? Then it goes," Xo wrote. "The tree stands." Each one.') == ['"Is it ready? Then it goes," Xo wrote.', '"The tree stands."', "Each one."]
    assert units("某人写道：“保存。验证！”模块读取。“单独。”完。") == ["某人写道：“保存。验证！”", "模块读取。", "“单独。”", "完。"]
    assert units("「守る。本当か？」と書いた。次だ。") == ["「守る。本当か？」と書いた。", "次だ。"]


def test_lines():
    text = "# Head one. Two\n\n- item one. Still\n- item two\nA text that\nwraps here.\n\n```\ncode. More.\n```\n\nPlain heading\n\nEnd"
    assert units(text) == ["# Head one. Two", "- item one. Still", "- item two", "A text that\nwraps here.", "Plain heading", "End"]


def test_scripts():
    assert units("यह है। वह है| क्या?") == ["यह है।", "वह है|", "क्या?"]
    assert units("انظر ص. 14 هنا. هل هذا؟ نعم!") == ["انظر ص. 14 هنا.", "هل هذا؟", "نعم!"]
    assert units("ครูแบ่งรูปภาพ นักเรียนวัดข้อมูลกับ Xo และครูนับ 3 ครั้ง") == ["ครูแบ่งรูปภาพ", "นักเรียนวัดข้อมูลกับ Xo และครูนับ 3 ครั้ง"]


def test_every_other_character_lies_in_one_unit(spark):
    texts = ["One. Two!  Three?\n\nFour", "  ", "", None, "字。字！", "A. " * 2000, "```\nopen code"]
    x = spark.createDataFrame([(i, t, "en" if i % 2 else None, 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, start_char int")
    got: dict = {}
    for r in sentences.sentence_units(x, "doc_id", "text", "lang").collect():
        got.setdefault(r.doc_id, []).append((r.start_char, r.end_char))
    for i, t in enumerate(texts):
        spans = sorted(got.get(i, []))
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
        inside = {k for a, b in spans for k in range(a, b)}
        if t and "```" not in t:
            assert all(c.isspace() or k in inside for k, c in enumerate(t))
    assert sentences.sentence_units(x.limit(0), "doc_id", "text", "lang").count() == 0


def test_learning(spark):
    rows = [(i, f"According to Dr. Name{i}, the tree grows.\n\nThe class met. The tree waits, see Fig. {i} of it.", "en") for i in range(60)]
    got = {(r.kind, r.type) for r in sentences.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang").collect()}
    assert {("abbr", "dr"), ("abbr", "fig")} <= got and ("abbr", "grows") not in got


def test_language_of_texts():
    en, de = "the class of the tree is in the house and that is for the end", "der Baum ist das Haus und nicht auf dem Weg von der Stadt"
    assert [sentences.spoken(en, x) for x in ("en", "und", "de", "hi", "it")] == ["en", "en", "en", "en", "it"]
    assert [sentences.spoken(de, x) for x in ("de", "und", "en", "zh")] == ["de"] * 4
    assert [sentences.spoken("", "en"), sentences.spoken("3.5", "hi"), sentences.spoken("", "und"), sentences.spoken("Xo 12", "und")] == ["en", "hi", "und", "und"]
    assert [sentences.spoken("यह line है और वह पेड़ है", x) for x in ("hi", "und", "en")] == ["hi", "hi", "en"]
    assert [sentences.spoken("字を書くのは次だ", "zh"), sentences.spoken("某人写道保存验证", "und"), sentences.spoken("это дом", "en")] == ["ja", "zh", "ru"]


def test_words_are_abbreviations_in_their_language_only(spark):
    hi = [(i, f"यह पेड़ है और वह देखता है line. {i} यहाँ है।\n\nवह पेड़ line. {i} है।", "hi") for i in range(40)]
    en = [(100 + i, f"The line of the tree is a line. Xo{i} waits for the line by the tree and that is the line of it all.", "en" if i % 2 else None) for i in range(20)]
    x = spark.createDataFrame([*hi, *en], "doc_id long, text string, lang string")
    assert ("hi", "abbr", "line") in {tuple(r) for r in sentences.learn(x, "text", "lang").select("lang", "kind", "type").collect()}
    one, two = "यह पेड़ है और वह देखता है line. Xo है", "The end of the line."
    both = sentences.Splitter([], {"hi": [("abbr", "line")], "en": []}).units(f"{one}\n{two} Xo", "hi")
    assert both == [(0, len(one) + 1 + len(two)), (len(one) + len(two) + 2, len(one) + len(two) + 4)]
    got = sentences.sentence_units(x, "doc_id", "text", "lang").where("doc_id >= 100").groupBy("doc_id").count().collect()
    assert len(got) == 20 and all(r["count"] == 2 for r in got)
