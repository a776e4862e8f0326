from oreworks.llm import language_id, queries


def test_held_out_accuracy(spark):
    rows = queries.queries()["op2_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    judged = rows.join(docs, "doc_id").where("held_out AND lang_pred <> 'und'")
    right = judged.where("lang = lang_pred").count()
    assert right / judged.count() > 0.97


def test_texts_without_letters_are_undetermined(make):
    docs = make(["the cat and the dog", None, "", "12 !? 34", "ein"])
    model = language_id.fit(docs)
    rows = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [rows[k].lang_pred for k in range(5)] == ["en", "und", "und", "und", "en"]
    assert rows[1].score == 0 and 0 < rows[0].score <= 1


def test_nothing_learned_and_empty(make):
    docs = make(["abc"])
    model = language_id.fit(docs.limit(0))
    assert language_id.identify(docs, model).first().lang_pred == "und"
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_fit_does_not_depend_on_the_order_of_rows(make):
    texts = [f"some words number {k} the" for k in range(40)]
    a = language_id.fit(make(texts))
    b = language_id.fit(make(texts[::-1] and list(enumerate(texts))[::-1]))
    assert (a.prototypes == b.prototypes).all()


def test_no_language_is_lost_without_ids(spark):
    """The bounded choice of texts goes by text as well, and finds some of every language."""
    words = {"en": "the quick fox", "de": "über die Straße", "fr": "ça été là", "es": "mañana y niño"}
    rows = [(None, f"{text} {k}", lang) for lang, text in words.items() for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, texts_per_language=50)
    assert set(model.languages) == set(words)
    found = language_id.identify(docs, model)
    wrong = found.join(docs, found["lang_pred"] == docs["lang"], "left_anti")
    assert wrong.isEmpty()
