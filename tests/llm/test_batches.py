"""How many whole texts go to a worker at a time."""

from lorebase.llm import packing, phrases
from lorebase.llm.common import BATCH_ROWS, small_batches
from lorebase.llm.queries import tokenizer


def test_texts_go_to_workers_in_small_batches(spark, monkeypatch):
    before, seen = spark.conf.get(BATCH_ROWS), []
    for module in (packing, phrases):
        store = module.stored
        monkeypatch.setattr(module, "stored", lambda rows, name, store=store: seen.append((name, spark.conf.get(BATCH_ROWS))) or store(rows, name))
    docs = spark.createDataFrame([(i, "en", "to be or not to be") for i in range(5)], "doc_id long, lang string, text string")
    assert phrases.collocations(docs, least=2).count() > 0 and packing.pack_documents(docs, tokenizer()).count() == 5
    assert dict(seen)["pieces"] == str(packing.TEXTS) and dict(seen)["word-counts"] == str(phrases.TEXTS)
    assert spark.conf.get(BATCH_ROWS) == before
    with small_batches(spark, 10**9):
        assert spark.conf.get(BATCH_ROWS) == before
