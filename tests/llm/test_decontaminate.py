import random

from pyspark.sql import functions as F

from skyledger.llm import decontaminate as D
from tests.conftest import SF
from tests.llm.common import frame

ITEM = "Yesterday Tom bought 8 kg of red apples and then Tom sold 2 kg to Ann in the market."


def items(spark, *texts):
    return spark.createDataFrame([(100 + i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, lang string")


def pairs(docs, benchmark):
    return sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, benchmark).collect())


def test_new_parameters_are_found_and_must_be_consistent(spark):
    docs = frame(
        spark,
        "Once Anna bought 5 kg of red apples and then Anna sold 3 kg to Peter in the market.",
        "so Mary bought twelve miles of red apples and then Mary sold 7 miles to John in the market today",
        "so Mary bought 12 kg of red apples and then Lucy sold 7 kg to John in the market today",
        "so Mary bought 12 kg of red apples and then Mary sold 12 kg to John in the market today",
        "so Mary bought 12 kg of green pears and later Mary gave 7 kg to John at the fair today",
    )
    assert pairs(docs, items(spark, ITEM)) == [(0, 100), (1, 100)]


def test_items_of_one_template_are_one(spark):
    other = ITEM.replace("Tom", "Bob").replace("8", "17")
    docs = frame(spark, "x y " + ITEM + " z", ITEM.replace(" ", "\n"), ITEM.upper())
    found = D.contaminated(docs, items(spark, other, ITEM, ITEM)).collect()
    assert sorted((r.doc_id, r.item_id, r.n_items) for r in found)[:2] == [(0, 100, 3), (1, 100, 3)]


def test_query_equals_shared_windows(spark):
    sf = SF.replace("0.001", "0.01")
    holders = {}
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = r.text.lower().split()
        for i in range(len(w) - 7):
            holders.setdefault(tuple(w[i : i + 8]), set()).add(r.item_id)
    wanted = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = r.text.lower().split()
        wanted |= {(r.doc_id, i) for k in range(len(w) - 7) for i in holders.get(tuple(w[k : k + 8]), ())}
    got = D.op1_decontaminate(spark, sf)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == wanted and wanted
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, benchmark = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    small = pairs(docs, benchmark)
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert pairs(docs, benchmark) == small


def test_edges(spark):
    docs = frame(spark, None, "", "words " * 100_000, ITEM, ITEM, "five short words of text").union(
        spark.createDataFrame([(None, ITEM, None, None, None), (3, ITEM, "en", "s", 1)], frame(spark, "").schema)
    )
    docs = docs.withColumn("pattern", F.lit("clash")).withColumn("item_id", F.lit("clash"))
    benchmark = items(spark, ITEM, None, "", "x y", "five short words of text", "1 2 3 4 5 6 7 8 9")
    found = D.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.item_id) for r in found if r.doc_id is not None) == [
        (False, 3, 100), (False, 4, 100), (False, 5, 104),
    ]
    assert sum(r.doc_id is None for r in found) == 1
    left = D.decontaminated(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [0, 1, 2]
    nameless = benchmark.withColumn("item_id", F.lit(None).cast("long")).filter(F.col("text") == ITEM)
    assert sorted(r.doc_id or -1 for r in D.contaminated(docs, nameless).collect()) == [-1, 3, 4]
    assert pairs(docs.limit(0), benchmark) == pairs(docs, benchmark.limit(0)) == []


def test_names_at_sentence_starts_and_copies_in_any_case(spark):
    item = "Tom has 5 apples. Ann gives him 3 pears. How many does Tom have?"
    docs = frame(
        spark,
        "Bob has 7 apples. Sue gives him 4 pears. How many does Bob have?",
        "BOB has 7 apples. Mary Lou gives him 4 pears. How many does BOB have?",
        "Bob has 7 apples. Sue gives him 4 pears. How many does Jim have?",
        item.lower(),
        item.upper(),
    )
    assert pairs(docs, items(spark, item)) == [(0, 100), (1, 100), (3, 100), (4, 100)]
    third = D.contaminated(frame(spark, "x", "y", ITEM.upper()), items(spark, ITEM, ITEM)).collect()
    assert [(r.doc_id, r.item_id, r.n_items) for r in third] == [(2, 100, 2)]


def test_slot_heavy_and_short_items_are_found_as_copies(spark):
    benchmark = items(spark, "What is 12 + 45?", "Who Wrote The Old Man And The Sea", "two words")
    docs = frame(
        spark, "so what is 12 + 45? ok", "say: who wrote the old man and the sea", "in two words here",
        "what is 12 + 46?", "two other words",
    )
    assert pairs(docs, benchmark) == [(0, 100), (1, 101), (2, 102)]
    # Fourteen words, five of seven windows slot-heavy: two are searched as templates, and both match.
    slots = items(spark, "from Al Bo Cy Di Ed Flo Gus take 1 2 then give back all")
    assert pairs(frame(spark, "from Ul Vo Wy Xi Yd Zlo Hus take 3 4 then give back all"), slots) == [(0, 100)]


def test_only_texts_with_an_anchor_are_read_in_all_forms_and_none_is_lost(spark, monkeypatch):
    rng = random.Random(5)
    odd = "New U.S. Two kg 5 Foo9 - O'Neil ΑΣ Β9 <0> x<n>y don't (Ann) Bob, 3.5 the of red apples sold. Why? état É. Kg‿9".split()
    odd += ["and so", "a<0", "McDonald", "sea\n", "\t!", "north", "wind", "blew", "hard", "today"]
    texts = [[rng.choice(odd) for _ in range(rng.randint(4, 24))] for _ in range(40)]

    def changed(words):
        """The words with some values, and some cases and signs, replaced."""
        values = {"New": "Old", "Two": "six", "5": "77", "Bob,": "Tom,", "(Ann)": "(Eve)", "Foo9": "FOO9", "red": "Red"}
        return [values.get(w, w) if rng.random() < 0.8 else w for w in words]

    held = [" ".join(["so", *changed(w), "then"]) for w in texts for _ in range(3)]
    # Only the open form's run of names that ends in no name is a word of both.
    glued = "Bo Cy newus Al Di 7 newus Ed"
    other = ["some other words that no item has at all, whatever they say"] * 200
    docs = frame(spark, *held, "Jo Wy New U.S. Xi Zu 9 New U.S. Ty", *other)
    benchmark = items(spark, *[" ".join(w) for w in texts], glued)
    calls = []
    near = D.near
    monkeypatch.setattr(D, "near", lambda *args: calls.append(near(*args)) or calls[-1])
    found = pairs(docs, benchmark)
    assert found and calls[0].count() <= len(held) + 1
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert pairs(docs, benchmark) == found and len(calls) == 1
