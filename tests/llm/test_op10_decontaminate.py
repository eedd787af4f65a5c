import re
from collections import Counter

from llm_data import DATA, long_text
from pyspark.sql import functions as F

from fleetmill.llm import op10_decontaminate as d
from fleetmill.llm.common import read

ITEM = "A farmer named Maria sells 12 apples and 30 pears to a trader named Jonas for 4 dollars, then buys 12 more apples from Jonas with the money."


def marked(text):
    text = re.sub("[§¤]", " ", text)
    text = re.sub(r"([0-9])[.,:/]([0-9])", r"\1_\2", text)
    text = re.sub(r"(?<!\w)([^\W\d_a-zß-ÿ])", r"§\1", text)
    return [w for w in re.split(r"[^\w§]+", text.lower()) if w]


def template(words):
    out = []
    for w in words:
        kind = d.NUMBER if w[0].isdigit() else d.NAME if w[0] == d.NAME else w
        out.append(d.UNIT if kind in d.UNITS and out and out[-1] == d.NUMBER else kind)
    return out


def windows(text):
    t = template(marked(text or ""))
    w = [tuple(t[i : i + 5]) for i in range(len(t) - 4)]
    return {i: x for i, x in enumerate(w) if sum(y not in (d.NUMBER, d.NAME, d.UNIT) for y in x) >= 3}


def agreement(item, text):
    """Slots at the alignment that most windows share, and those of them that agree."""
    own, other, words, theirs = windows(item), windows(text), marked(item), marked(text)
    shifts = Counter(j - i for i, a in own.items() for j, b in other.items() if a == b)
    shift = min(shifts, key=lambda s: (-shifts[s], s))
    at = lambda k: theirs[k] if 0 <= k < len(theirs) else None
    kind = lambda w: "#" if w[0].isdigit() else "§" if w[0] == "§" else None
    slots = []
    for i, w in enumerate(words):
        beside = any(0 <= k < len(words) and words[k] == at(k + shift) for k in (i - 1, i + 1))
        if beside and kind(w) and at(i + shift) and kind(w) == kind(at(i + shift)):
            slots.append((w, at(i + shift)))
    return len(slots), sum(max(Counter(b for a, b in slots if a == v).values()) for v in {a for a, _ in slots})


def plain(text):
    w = re.findall(r"\w+", text.lower().replace("ß", "ss").replace("ς", "σ"))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}, w


def brute(docs, items):
    """(document, item) -> slots and those that agree."""
    out = {}
    for i, item in items:
        own, (folded, words) = set(windows(item).values()), plain(item)
        for k, text in docs:
            if own and len(own & set(windows(text).values())) >= 0.8 * len(own) and 2 * (got := agreement(item, text))[1] >= got[0]:
                out[k, i] = got
            elif (folded and len(folded & plain(text)[0]) >= 0.8 * len(folded)) or (0 < len(words) < 5 and plain(text)[1] == words):
                out[k, i] = (0, 0)
    return out


def found(spark, docs, items):
    got = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]): r for r in got.collect()}


def test_copies_and_new_parameters_are_caught_and_contradictions_are_not(spark):
    around = long_text(60)
    new = ITEM.replace("12", "45").replace("30", "8").replace("Maria", "Peter").replace("Jonas", "Anna")
    altered = ITEM.replace("buys 12 more", "buys 99 more").replace("from Jonas", "from Klara")
    same = "He adds 3 litres of oil, then pours 3 litres of milk, then stirs 3 litres of water and takes 3 litres of juice from there."
    random = "He adds 4 litres of oil, then pours 5 litres of milk, then stirs 6 litres of water and takes 7 litres of juice from there."
    docs = [(1, f"{around}. {ITEM} {around}"), (2, f"{around}. {new} {around}"), (3, f"{around}. {altered} {around}"), (9, random), (4, around), (5, ITEM[: len(ITEM) // 2]), (6, None), (7, ""), (None, ITEM), (8, ITEM), (8, ITEM)]
    got = found(spark, docs, [(1, ITEM), (2, None), (3, ""), (4, "too few words"), (5, same), (None, ITEM)])
    assert set(got) == {(1, 1), (2, 1), (3, 1), (8, 1)} and got[(2, 1)]["n_slots"] >= 6 == got[(2, 1)]["n_agree"] - 2
    assert got[(3, 1)]["n_agree"] == got[(3, 1)]["n_slots"] - 2


def test_names_at_starts_merged_and_split_values_are_caught(spark):
    item = "Maria has 12 apples in a basket. Maria buys 30 more at the market near her house. Maria then gives 5 of the apples away to a friend and keeps all others."
    road = "A cyclist rides 3 km along the river and then 3 km through the forest before he stops for 20 minutes at the old mill to have lunch."
    docs = [(1, item.replace("Maria", "Peter").replace("30", "45")), (2, item.replace("12", "8").replace("30", "8")), (3, road.replace("3 km along", "7 km along").replace("3 km through", "5 km through")), (4, long_text(80))]
    assert set(found(spark, docs, [(1, item), (2, road)])) == {(1, 1), (2, 1), (3, 2)}


def test_items_of_few_words_are_held_by_equal_documents(spark):
    docs = [(1, "What is love?"), (2, "what  is LOVE"), (3, "Tell me what is love, please, now"), (4, ""), (5, "42")]
    got = found(spark, docs, [(1, "What is love?"), (2, "42"), (3, "?!")])
    assert set(got) == {(1, 1), (2, 1), (5, 2)}


def test_keys_beyond_a_broadcast_give_the_same(spark, monkeypatch):
    from fleetmill.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    docs = [(i, f"{long_text(60, i)} {ITEM if i % 3 == 0 else ''} {long_text(30, i + 5)}") for i in range(9)]
    assert set(found(spark, docs, [(1, ITEM), (2, long_text(30, 99))])) == {(0, 1), (3, 1), (6, 1)}


def test_equals_brute_force_on_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, DATA, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in read(spark, DATA, "benchmark").collect()]
    assert {k: (r["n_slots"], r["n_agree"]) for k, r in found(spark, docs, items).items()} == brute(docs, items) != {}


def test_odd_rows_and_plain_plan(spark, odd_docs, no_docs):
    items = odd_docs.select(F.col("doc_id").alias("item_id"), "text", F.lit("x").alias("doc_id"))
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(odd_docs, items).collect()}
    assert got >= {(1, 1), (5, 5)}
    assert d.contaminated(no_docs, items).count() == 0 and d.contaminated(odd_docs, items.limit(0)).count() == 0
    plan = d.query(spark, DATA)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_items_in_other_case_and_spacing_are_caught(spark):
    """Against words folded without marking names; every such whole item is to be reported."""
    item, german = ITEM, "Anna, Bernd, Carla und Doris messen die Straße: 3 Äpfel, 4 Birnen und 5 Kirschen, 3 davon süß."
    forms = [str.upper, str.lower, str.title, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" ", "  "), lambda t: t.upper().replace(" ", "\t")]
    docs = [(10 * i + k, f"{long_text(40, k)}, {form(text)} {long_text(40, i)}") for i, form in enumerate(forms) for k, text in enumerate((item, german))]
    fold = lambda t: " ".join(re.findall(r"[^\W_]+", t.casefold()))
    want = {(d_id, k) for d_id, text in docs for k, own in enumerate((item, german)) if f" {fold(own)} " in f" {fold(text)} "}
    assert len(want) == len(docs) and set(found(spark, docs, [(0, item), (1, german)])) == want
