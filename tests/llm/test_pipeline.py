import random

import corpus_pipeline
from ambry.llm.common import written
from ambry.llm.hash_tree import layout
from tests.llm.test_decontaminate import by_hand as holding
from tests.llm.test_hash_tree import by_hand as shard_by_hand
from tests.llm.test_signature_tree import by_hand as groups
from tests.llm.test_source_mix import by_hand as mix_by_hand
from tests.llm.test_string_kernel import SYLLABLES, text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


def made(spark, tmp):
    rng = random.Random(8)
    items = [(i, text("aa", rng, 30)) for i in range(5)]
    rows = []
    for i in range(150):
        lang = rng.choice(list(SYLLABLES))
        t = text(lang, rng, rng.randrange(20, 80))
        if rows and i % 5 == 0:
            t = rng.choice(rows)[1]
        if i % 11 == 3:
            t += " " + rng.choice(items)[1]
        rows.append((i, t, lang, rng.choice(["a", "b", "c", None]), len(t), "s"))
    rows += [(900, None, None, "a", 0, "s"), (901, "12 34", "aa", "b", 5, "s")]
    for name, r, schema in (("documents", rows, SCHEMA), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(r, schema).write.parquet(f"{tmp}/{name}.parquet")
    return rows, items


def test_every_stage_against_plain_python(spark, tmp_path):
    rows, items = made(spark, tmp_path)
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), name)
        kept[name] = [tuple(r) for r in docs.collect()]
        assert name == "shard" or docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    by_id = {r[0]: r for r in rows}
    assert {r[0] for r in kept["language"]} == set(by_id) - {900, 901}
    component = groups([(r[0], r[1]) for r in kept["language"]])
    assert {r[0] for r in kept["near_duplicates"]} == {i for i, (_, c) in component.items() if c == i}
    held = {d for d, _ in holding([(r[0], r[1]) for r in kept["near_duplicates"]], items)}
    assert held and {r[0] for r in kept["benchmark_passages"]} == {r[0] for r in kept["near_duplicates"]} - held
    assert all(r == by_id[r[0]] for r in kept["benchmark_passages"])
    taken = {x[0]: x[4] for x in mix_by_hand([(r[0], r[3], r[1]) for r in kept["benchmark_passages"]])}
    words = {}
    for r in kept["mix_sources"]:
        words[r[0]] = words.get(r[0], 0) + len(r[1].split())
    assert words == {i: n for i, n in taken.items() if n}
    assert sorted((r[0], r[4]) for r in kept["shard"]) == sorted((r[0], shard_by_hand(str(r[0]), layout(8))) for r in kept["mix_sources"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(kept["shard"])


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_language_stage_rejects_what_resembles_none(spark, tmp_path):
    for langs in (["aa"], ["aa", "bb"], list(SYLLABLES)):
        rng = random.Random(4)
        rows = [(i, text(langs[i % len(langs)], rng, rng.randrange(8, 80)), langs[i % len(langs)]) for i in range(240)]
        clean = {1000 + i: text(lang, rng, n) for i, (lang, n) in enumerate((lang, n) for lang in langs for n in [1] * 10 + [3, 200])}
        bad = ["Привет, как дела сегодня", "語言識別很難", "я", "語", "xkcd qzjv wvbq pjxk zqvw bvxz", "Zxqvkj", "asdfjkl qwerzuiop yxcvm " * 20]
        strange = {2000 + i: t for i, t in enumerate(bad)}
        rows += [(i, t, None) for i, t in (clean | strange).items()]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        path = str(tmp_path / "".join(langs))
        docs.write.parquet(path)
        kept = {r.doc_id for r in corpus_pipeline.language(spark, spark.read.parquet(path), "").collect()}
        assert kept == {r[0] for r in rows} - set(strange)
