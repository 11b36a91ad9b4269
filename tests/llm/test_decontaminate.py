import random
import re

import pytest
from pyspark.sql import functions as F

from brightledger.llm import decontaminate
from brightledger.llm.queries import QUERIES

from .cases import documents, none, prose

QUESTION = "A train leaves the old station with Maria at noon and travels 120 km in 2 hours, then Maria waits 15 minutes."
ITEMS = "item_id long, text string"


def found(spark, texts, items, schema="doc_id long, text string", **how):
    df = spark.createDataFrame(list(enumerate(texts)), schema)
    made = decontaminate.contaminated(df, spark.createDataFrame(items, ITEMS), **how).collect()
    assert len(made) == len(texts)
    return {r["doc_id"]: list(r["item_ids"]) for r in made if r["contaminated"]}


def around(text):
    return prose(1, 30) + " " + text + " " + prose(2, 30)


def test_reparameterised_question_is_caught_and_inconsistent_one_is_not(spark):
    other = QUESTION.replace("Maria", "Peter").replace("120 km", "80 miles").replace("15", "45")
    mixed = other.replace("then Peter", "then Paul")
    merged = QUESTION.replace("120", "15")
    texts = [around(QUESTION), around(other), around(mixed), around(merged), prose(3, 80), around(QUESTION.replace("station", "harbour"))]
    hits = found(spark, texts, [(7, QUESTION)])
    assert hits == {0: [7], 1: [7], 5: [7]}


def test_short_items_runs_and_punctuation(spark):
    nine = "alpha beta gamma delta epsilon zeta eta theta iota"
    words = prose(5, 40)
    part = " ".join(words.split()[11:22])
    texts = [
        around(nine), around(" ".join(nine.split()[:8])), around("*** ".join(nine.split()) + "###"),
        around(part), around(" ".join(part.split()[:8])), around("alpha beta gamma"),
    ]
    assert found(spark, texts, [(1, nine), (2, words), (3, "alpha beta gamma")]) == {0: [1], 2: [1], 3: [2]}


def test_awkward_rows(spark):
    item = prose(3, 33)
    extra = [(None, "x " + item, None, "s", 1), (80, item, None, "s", 1), (80, item, None, "s", 1), (80, "other text", None, "s", 1)]
    df = documents(spark, extra).withColumn("item_ids", F.lit("clash")).withColumn("row", F.lit(1))
    items = spark.createDataFrame([(3, item), (3, item), (4, None), (None, item), (5, ""), (3, prose(77, 20))], ITEMS).withColumn("window", F.lit(1))
    rows = decontaminate.contaminated(df, items).collect()
    hits = sorted((r["doc_id"] or -1 for r in rows if r["contaminated"]))
    assert len(rows) == df.count() and hits == [-1, 3, 20, 80, 80]
    kept = decontaminate.clean(df, items)
    assert kept.columns == df.columns and kept.count() == df.count() - 5


def test_empty_tables(spark):
    items = spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminated(none(spark), spark.createDataFrame([(1, QUESTION)], ITEMS)).count() == 0
    assert decontaminate.contaminated(documents(spark), items).where("contaminated").count() == 0


@pytest.mark.parametrize("most", [0, 10**6])
def test_shuffled_and_broadcast_windows_agree(spark, sf_dir, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    rows = QUERIES["op2_template_decontamination"](spark, sf_dir).collect()
    assert {r["doc_id"]: list(r["item_ids"]) for r in rows if r["contaminated"]} == brute(spark, sf_dir)


def brute(spark, sf_dir):
    """The items whose words (no numbers or names occur in them) lie in a text, ten in a row."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
    cut = lambda text: re.findall(r"[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*", text)
    held, hits = {}, {}
    for r in read("benchmark"):
        words = [w.lower() for w in cut(r["text"])]
        size = min(decontaminate.RUN, len(words))
        for n in range(len(words) - size + 1):
            held.setdefault(tuple(words[n : n + size]), set()).add(r["item_id"])
    sizes = {len(k) for k in held}
    for r in read("documents"):
        words = [w.lower() for w in cut(r["text"])]
        items = {i for s in sizes for n in range(len(words) - s + 1) for i in held.get(tuple(words[n : n + s]), ())}
        if items:
            hits[r["doc_id"]] = sorted(items)
    return hits


def test_no_python_in_the_plan(spark, sf_dir):
    df = QUERIES["op2_template_decontamination"](spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


TRAIN = "A train travels 60 km in 2 hours and 90 km in 3 hours. What is its average speed?"


def test_item_dense_in_slots(spark):
    other = TRAIN.replace("60 km", "70 miles").replace("90 km", "80 miles").replace("3 hours", "4 hours")
    bare = "7 8 9 10 11 12 13 14 15 16 17 18"
    table = f"Of the years {bare} only the last was any good."
    texts = [around(TRAIN), around(other), around("1 2 3 4 5 6 7 8 9 10 11 12"), around(table.replace("7 8", "5 6"))]
    assert found(spark, texts, [(1, TRAIN), (2, table)]) == {0: [1], 1: [1], 3: [2]}


def test_one_changed_value_and_chance_placeholder_after_a_passage(spark):
    long = "In 2019 the small town built a new bridge over the wide river and opened it to everyone before the end of 2019 with music."
    passage = "Anna told 12 of the older children to carry 7 wooden boxes up to the attic and found 30 keys there."
    # The copy stops before the keys, and a number that stands for another value already follows by chance.
    part = "Anna told 30 of the older children to carry 8 wooden boxes up to the attic and found 30 of them."
    texts = [around(long), around(long.replace("of 2019", "of 2020")), around(part)]
    assert found(spark, texts, [(1, long), (2, passage)]) == {0: [1], 1: [1], 2: [2]}


def test_copies_in_other_case_and_other_lines(spark):
    wrapped = QUESTION.replace("with Maria", "with\nMaria").replace("then Maria", "then\nMaria")
    texts = [around(QUESTION.lower()), around(QUESTION.upper()), around(wrapped), around(QUESTION.lower().replace("noon", "dawn").replace("2", "3"))]
    assert found(spark, texts, [(1, QUESTION)]) == {0: [1], 1: [1], 2: [1]}


def test_items_shorter_than_a_window_and_scripts_without_blanks(spark):
    short, chinese, thai = "What is the capital city of France?", "小明有三个苹果和五个梨他一共有多少个水果", "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"
    texts = [
        around(short), around(short.lower()), around(short.replace("France", "Spain")),
        "前面的话" * 5 + chinese + "后面的话" * 5, around("x" + thai + "x"), "别的故事讲的是一条河和一座山没有数字", around("Add 2 and 3"), around("Add 2 and 4"),
    ]
    items = [(1, short), (2, chinese), (3, thai), (4, "Add 2 and 3")]
    assert found(spark, texts, items) == {0: [1], 1: [1], 3: [2], 4: [3], 6: [4]}


APPLES = "Tom has 5 red apples and buys 12 more at the market. Tom then gives 3 of them to his sister, how many are left?"


def test_values_that_coincide_and_names_that_begin_a_sentence(spark):
    with_values = lambda a, b, c: APPLES.replace("5", a).replace("12", b).replace("3", c)
    tom, anna = with_values("7", "4", "4"), with_values("7", "4", "4").replace("Tom", "Anna")
    begins = "Tom has 7 apples and 4 pears; Ann eats 1."
    texts = [
        around(tom), around(anna), around("Tim has 8 apples and 5 pears; Eve eats 2."), around(begins),
        around("Tim had 8 apples and 5 pears; Eve ate 2."), around(with_values("7", "4", "4").replace("apples", "pears").replace("market", "shop")),
    ]
    hits = found(spark, texts, [(1, APPLES), (2, begins)], one_to_one=False)
    assert {n: hits.get(n) for n in range(5)} == {0: [1], 1: [1], 2: [2], 3: [2], 4: None}


def test_a_second_value_ends_the_run_and_short_parts_are_no_match(spark):
    other = QUESTION.replace("Maria", "Peter").replace("120 km", "80 miles").replace("15", "45")
    late, merged = other.replace("then Peter", "then Paul"), QUESTION.replace("120", "15")
    # Every tenth word at most is a slot with one more value for the same value of the item.
    dense = "Peter saw the gate and Peter shut it so that Peter could call home and Peter ran off while Peter slept well"
    names = iter(("Anna", "Carl", "Doris", "Emil", "Fritz"))
    mixed = " ".join(next(names) if w == "Peter" else w for w in dense.split())
    texts = [around(late), around(merged), around("so " + dense), around("so " + mixed), around("so " + dense.replace("Peter", "Carl"))]
    assert found(spark, texts, [(1, QUESTION), (2, "so " + dense)], one_to_one=False) == {0: [1], 1: [1], 2: [2], 4: [2]}


def plain_slots(text):
    """(kind, value, capitalised) of each word, one after the other."""
    made, before = [], "."
    for token in re.findall(r"[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*|[.!?\n]", text):
        low, capital = token.lower(), len(token) > 1 and token[0] != token[0].lower() and token[1:] == token[1:].lower()
        if token[0].isdigit():
            kind = decontaminate.NUMBER
        elif before[0].isdigit() and low in decontaminate.UNITS:
            kind = decontaminate.UNIT
        else:
            kind = decontaminate.NAME if capital and before not in decontaminate.BREAKS else low
        if token not in decontaminate.BREAKS:
            made.append((kind, low, capital))
        before = token
    return made


def seeded(laid, item):
    """Whether kinds agree in a window's words in a row, enough of them or up to a capitalised word."""
    kinds = "".join("x" if there[0] == own[0] else " " for _, there, own in laid)
    for run in re.finditer("x{%d,}" % decontaminate.WINDOW, kinds):
        first, end = (laid[0][0] + at for at in run.span())
        beside = [item[at][2] for at in (first - 1, end) if 0 <= at < len(item)]
        literals = sum(not slot[0].startswith("<") for slot in item[first:end])
        if literals >= decontaminate.LITERALS and (end - first >= min(decontaminate.RUN, len(item)) or any(beside)):
            return True
    return False


def plain_holds(text, item):
    """Whether some stretch of the item, laid over the text at any place, is a match."""
    least, least_copied = min(decontaminate.RUN, len(item)), min(decontaminate.VERBATIM, len(item))
    for shift in range(1 - len(item), len(text)):
        values, begin, copied = {}, 0, 0
        laid = [(n, text[n + shift], slot) for n, slot in enumerate(item) if 0 <= n + shift < len(text)]
        looked_at = seeded(laid, item)
        for place, (n, there, own) in enumerate(laid):
            named = there[0] != own[0] and there[2] and own[2]
            copied = copied + 1 if there[1] == own[1] else 0
            if copied >= least_copied:
                return True
            if not looked_at or (there[0] != own[0] and not named):
                values, begin = {}, place + 1
                continue
            kind = decontaminate.NAME if named else own[0]
            if kind.startswith("<"):
                clashes = [at for (k, v, w), at in values.items() if (k, v) == (kind, own[1]) and w != there[1]]
                begin = max([begin, *[at + 1 for at in clashes]])
                values[kind, own[1], there[1]] = place
            literals = sum(not (t[0].startswith("<") or (t[0] != o[0])) for _, t, o in laid[begin : place + 1])
            if place + 1 - begin >= least and literals >= decontaminate.LITERALS:
                return True
    return False


@pytest.mark.parametrize("seed", [1, 2])
def test_slots_against_a_plain_version(spark, seed):
    draw = random.Random(seed)
    people, units = ["Anna", "Bruno", "Carla", "Dora", "Emil"], ["km", "miles", "kg", "hours"]

    def question(n):
        words = prose(100 * seed + n, 60).lower().split()
        sentences = []
        for at in (0, 15):
            own = words[at : at + 11]
            for place in draw.sample(range(1, 10), draw.randrange(1, 4)):
                own[place] = draw.choice([draw.choice(people), str(draw.randrange(1, 60)), f"{draw.randrange(2, 9)} {draw.choice(units)}"])
            sentences.append(" ".join([draw.choice(people), *own]))
        return ". ".join(sentences) + "."

    def changed(text):
        """Values replaced one by one or each everywhere, and now and then a word."""
        values = {}
        everywhere, part = draw.random() < 0.5, draw.choice([0.2, 0.6, 1.0])

        def other(match):
            word = match.group()
            pool = people if word in people else units if word in units else [str(n) for n in range(1, 30)]
            if draw.random() > part:
                return word
            return values.setdefault(word, draw.choice(pool)) if everywhere else draw.choice(pool)

        words = re.sub("|".join([*people, r"\b\d+\b", *(rf"\b{u}\b" for u in units)]), other, text).split()
        for _ in range(draw.choice([0, 1, 2, 3, 6])):
            words[draw.randrange(len(words))] = "replaced"
        return " ".join(words)

    items = [(n, question(n)) for n in range(12)]
    texts = [around(changed(text)) for _, text in items for _ in range(10)] + [prose(n, 90) for n in range(10)]
    wanted = {}
    for n, text in enumerate(texts):
        held = [i for i, item in items if plain_holds(plain_slots(text), plain_slots(item))]
        if held:
            wanted[n] = held
    assert 30 < len(wanted) < len(texts) - 30
    assert found(spark, texts, items, one_to_one=False) == wanted
