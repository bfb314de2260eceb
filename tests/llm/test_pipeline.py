"""The pipeline's stages on odd rows, each on its predecessor's rows."""

import random

import corpus_pipeline


def test_stages_on_odd_rows(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, good, "en", "a", 1), (2, good, "en", "b", 1), (3, None, None, None, None), (4, "short", "en", "a", 5), (5, "x y z " * 60, "en", "a", 1),
            (None, good + " more", "en", "a", 1), (7, " ".join(f"other{i}" for i in range(90)), "en", "b", 1)]
    spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, columns)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(sorted({r.doc_id for r in docs.collect()}, key=str))
    assert kept[0] == kept[1] == [1, 2, 7, None] and kept[2] == [1, 7, None]
    empty = spark.createDataFrame([], columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_language_stage_removes_unlearned_languages_and_gibberish(spark, tmp_path):
    rng = random.Random(4)
    syllables = {"en": "the ing and ion ent for her that tha ere ate his con res ver all ons nce men ith".split(),
                 "de": "der sch ein ich und gen cht ung die den auf ges ver keit ber lich ten aus vor nde".split()}

    def prose(lang, n):
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))

    rows = [(i, prose(lang, rng.choice((60, 120, 400))), lang) for i, lang in enumerate(["en", "de"] * 150)]
    clean = [(1000 + i, prose(lang, 150), None) for i, lang in enumerate(["en", "de"] * 10)]
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(80))
    polish = ("wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci i swych praw sa oni obdarzeni rozumem i sumieniem "
              "i powinni postepowac wobec innych w duchu braterstwa ") * 3
    finnish = ("kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu jarki ja omatunto "
               "ja heidan on toimittava toisiaan kohtaan veljeyden hengessa ") * 3
    code = "if x0 == y1 : return xs [ k ] ; while q : pop ( q ) ; jmp xor mov eax ebx " * 8
    odd = [(2000 + i, t, None) for i, t in enumerate([noise, polish, finnish, code])]
    docs = spark.createDataFrame([(*r, "clash") for r in rows + clean + odd], "doc_id long, text string, lang string, language string")
    kept = corpus_pipeline.language_id(spark, docs, str(tmp_path))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and kept.first().language == "clash"
    assert not ids & {r[0] for r in odd}
    assert ids >= {r[0] for r in clean} and len(ids & {r[0] for r in rows}) >= 0.99 * len(rows)
