import pyarrow.parquet as pq

from tavola.llm.decontaminate import contaminated, op7_template_decontamination
from tests.llm.conftest import EDGE, TINY

ITEM = ("Alice bought 12 kg of apples from Bob and then Alice sold 5 kg of them to Carol "
        "for 30 dollars so how many apples does Alice still have")


def test_templates_and_slots(spark, make):
    item = ITEM.split()
    def swap(**by):
        return " ".join(by.get(w, w) for w in item)
    dora = {"Alice": "Dora", "12": "77", "5": "9", "30": "41", "kg": "lbs", "Bob": "Ed", "Carol": "Zoe"}
    inconsistent = " ".join("Dora" if w == "Alice" and i < 5 else "Eve" if w == "Alice" else w for i, w in enumerate(item))
    rows = EDGE + [(10, "x y z " + ITEM + " more text"), (11, "he said: " + " ".join(dora.get(w, w) for w in item) + "!"),
                   (12, inconsistent), (13, " ".join(item[:12])), (14, "the cat sat on the mat " * 30),
                   (15, ITEM + ". " + ITEM), (15, ITEM), (16, "w " * 100_000 + ITEM), (17, "red green blue pink grey"),
                   (18, "one " + " ".join(item[3:20]) + " two")]
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short"), (5, "red green blue pink grey"),
                                   (None, ITEM), (6, "12 Alice 14 Bob 3 Carol 9 km 8")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(make(rows), items).collect()}
    assert set(got) == {(10, 1), (11, 1), (15, 1), (16, 1), (17, 5), (18, 1)}
    assert got[10, 1].n_changed == 0 and got[11, 1].n_changed == 10 and got[11, 1].n_windows == len(item) - 12
    assert contaminated(make([]), items).count() == 0 and contaminated(make(rows), items.limit(0)).count() == 0


def test_verbatim_passages_are_found(spark):
    docs = pq.read_table(f"{TINY}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    items = pq.read_table(f"{TINY}/benchmark.parquet").to_pylist()
    planted = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    got = {(r.doc_id, r.item_id) for r in op7_template_decontamination(spark, TINY).collect()}
    assert planted and planted <= got
    clean = {d["doc_id"] for d in docs if not any(" ".join(i["text"].split()[j:j + 6]) in d["text"] for i in items for j in range(5))}
    assert not {d for d, _ in got} & clean
