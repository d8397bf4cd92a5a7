import random

import pyarrow as pa

from ledgerloom.llm.contamination import (
    NAME,
    NUMBER,
    PLAIN_WORD,
    UNIT,
    canonicalise,
    drop_leaking,
    find_leaks,
)
from ledgerloom.llm.words import text_bytes

from .messy import ROWS, documents

ITEM = "Maria drives 60 km to Paris and then 60 km back to meet Maria. How far does Maria drive on that day?"


def test_types():
    words = canonicalise(*text_bytes(pa.array(["The man (Tom) ran 5 km. Then USA, 3.5kg É Élan", None, ""])))
    assert words.kind.tolist() == [
        PLAIN_WORD, PLAIN_WORD, NAME, PLAIN_WORD, NUMBER, UNIT, PLAIN_WORD, PLAIN_WORD, NUMBER, PLAIN_WORD, NAME
    ]
    one = canonicalise(*text_bytes(pa.array(["ÉLAN FÜR ALLE"])))
    two = canonicalise(*text_bytes(pa.array(["élan für alle."])))
    assert one.canonical.tolist() == two.canonical.tolist()


def leaks(spark, texts, items=((7, ITEM),), **options):
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    bench = spark.createDataFrame(list(items), "item_id bigint, text string")
    return {r.doc_id: [x.item_id for x in r.leaks] for r in find_leaks(docs, bench, **options).collect()}


def test_slots_have_to_agree(spark):
    texts = [
        "before it. " + ITEM + " and after.",
        ITEM.upper(),
        ITEM.replace("60", "85").replace("Maria", "Peter").replace("Paris", "Rome").replace("km", "miles"),
        ITEM.replace("60", "85", 1),  # one number stands for two
        ITEM.replace("Paris", "Maria"),  # two names stand for one
        "a clean text about a day on which nobody drives anywhere at all, 60 km or not",
        ITEM[:30],
        None,
        "",
    ]
    found = leaks(spark, texts)
    assert [bool(found[i]) for i in range(len(texts))] == [True, True, True, False, False, False, False, False, False]


def test_one_altered_value_leaves_the_words_around_it(spark):
    texts = [
        ITEM.replace("60", "85", 1),
        ITEM.replace("Paris", "Maria"),
        "x " + ITEM.replace("km back", "miles back"),
        "x " + ITEM.replace("60", "85", 1).replace("meet Maria", "meet Peter").replace("on that", "on this"),
        "a clean text about a day on which nobody drives anywhere at all, 60 km or not",
    ]
    found = leaks(spark, texts, verbatim=True)
    # Of the fourth text only 10 of 22 words lie in 8 equal ones or more.
    assert [found[i] for i in range(len(texts))] == [[7], [7], [7], [], []]


KINDS = {**dict.fromkeys(["Anna", "Peter", "Maria"], NAME), **dict.fromkeys(["km", "miles", "days"], UNIT)}


def kind_of(word):
    return NUMBER if word[0].isdigit() else KINDS.get(word, PLAIN_WORD)


def brute(item, doc):
    """Words of the item covered by the document, every alignment and stretch tried."""
    covered = set()
    for shift in range(-len(item), len(doc)):
        at = [i for i in range(len(item)) if 0 <= i + shift < len(doc)]
        same = {i for i in at if (k := kind_of(item[i])) == kind_of(doc[i + shift])
                and (k != PLAIN_WORD or item[i] == doc[i + shift])}
        for a in range(len(item)):
            z = a
            while z in same:
                z += 1
            if a - 1 in same or z - a < 8:
                continue
            pairs = [(kind_of(item[i]), item[i], doc[i + shift]) for i in range(a, z)]
            slots = {p for p in pairs if p[0] != PLAIN_WORD}
            agree = len({s[:2] for s in slots}) == len(slots) == len({s[::2] for s in slots})
            equal = all(p[1] == p[2] for p in pairs)
            if agree and (equal or sum(p[0] == PLAIN_WORD for p in pairs) >= 3):
                covered.update(range(a, z))
            for b in range(a, z - 7):
                if all(p[1] == p[2] for p in pairs[b - a : b - a + 8]):
                    covered.update(range(b, b + 8))
    return len(covered)


def test_altered_items_against_brute_force(spark):
    rnd = random.Random(2)
    values = [["3", "7", "60"], ["Anna", "Peter", "Maria"], ["km", "miles", "days"]]
    items, texts = [], []
    for i in range(25):
        words = [f"i{i}"]
        for n in range(rnd.randrange(8, 50)):
            words.append(rnd.choice(rnd.choice(values)) if rnd.random() < 0.3 else f"w{rnd.randrange(40)}")
        items.append(words)
        for _ in range(6):
            doc = list(words)
            for _ in range(rnd.randrange(4)):
                place = rnd.randrange(len(doc))
                same = [v for v in values if doc[place] in v]
                doc[place] = rnd.choice(same[0]) if same else rnd.choice([doc[place], "new"])
            swap = dict(zip(values[1], rnd.sample(values[1], 3))) if rnd.random() < 0.3 else {}
            texts.append(["before", *[swap.get(w, w) for w in doc], "after"])
    bench = [(i, " ".join(words)) for i, words in enumerate(items)]
    found = leaks(spark, [" ".join(t) for t in texts], bench, verbatim=True)
    want = {t: [i for i, item in enumerate(items) if brute(item, text) >= 0.5 * len(item)] for t, text in enumerate(texts)}
    assert found == want and 60 < sum(map(bool, want.values())) < len(texts)


def test_blocks_give_the_same(spark):
    items = [(i, f"question number of item{i} asks about thing{i} and also about other{i} here") for i in range(20)]
    items += [(20, "short item"), (21, None), (None, "no id for this one"), (22, " "), (0, items[0][1])]
    texts = [f"x y. {t} z" for _, t in items[:20]] + ["a short item here", "no id for this one"]
    whole = leaks(spark, texts, items)
    assert whole == leaks(spark, texts, items, block_words=30)
    assert whole == {**{i: [i] for i in range(20)}, 20: [20], 21: []}


def test_messy_rows(spark):
    df = documents(spark)
    bench = spark.createDataFrame([(1, ROWS[0][1]), (2, "word5 word6 word7 word8 word9 word10 word11 word12 word13")], "item_id bigint, text string")
    out = find_leaks(df, bench)
    assert out.count() == len(ROWS) and set(out.columns) == set(df.columns)
    assert {r.doc_id for r in out.where("size(leaks) > 0").collect()} == {1, 6, 7}
    assert drop_leaking(df, bench).count() == len(ROWS) - 4
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert find_leaks(df, none).where("size(leaks) > 0").count() == 0
    assert find_leaks(documents(spark, []), bench).count() == 0
