"""Operators of the problems tagged llm on small cases and against brute force."""

import itertools
import random
import tempfile

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tarn.llm import fillers, leakage, matching, tokenizer
from tarn.llm.canonical import NameList, Trie, all_within, resolve_names
from tarn.llm.fillers import STATES, SYMBOLS, Model, filler, label, learned, other_share, posteriors, symbols, units
from tarn.llm.leakage import Patterns, leaks, letters_and_digits
from tarn.llm.matching import MatchParameters, kilometres, linked, minutes, tokens_of
from tarn.llm.spelling import fold, latin, romaji
from tarn.llm.tokenizer import DEFAULT_VOCABULARY, encoded, merges

LIST = [(1, "石鎚山", "いしづちさん", "西条市"), (2, "瓶ヶ森", "かめがもり", "西条市"), (3, "広沢ノ塚", "ひろさわのつか", "甲町"), (4, "堂ヶ森", "どうがもり", "乙町"), (5, "赤石山", "あかいしやま", "甲町"), (6, "赤石山", "あかいしやま", "丙ヶ原村"), (7, None, "x", None)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edits(a, b):
    """Optimal string alignment, whole table."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=7), min_size=1, max_size=12, unique=True), st.text(alphabet="abc", max_size=8), st.integers(0, 2))
def test_automaton_against_all_pairs(forms, text, most):
    trie = Trie()
    for i, form in enumerate(forms):
        trie.add(form, i, 2)
    assert trie.search(text, most) == {i: edits(text, f) for i, f in enumerate(forms) if edits(text, f) <= most}


@pytest.mark.parametrize(
    "text, numbers",
    [
        ("石鎚山", [1]), ("石 鎚　山縦走", [1]), ("新緑のイシヅチサン（途中撤退）", [1]), ("ISHIZUCHISAN", [1]), ("Mt. Kamega-mori", [2]), ("瓶が森・広澤之塚", [2, 3]), ("瓶ヶ嶺", [2]), ("堂ヶ", [4]), ("廣沢ノ塚 2日目", [3]), ("広沢塚ノ", [3]),
        ("かめがもし", [2]), ("赤石山【甲】", [5]), ("赤石山(丙ヶ原村)", [6]), ("赤石山", [5, 6]), ("富士山", []), ("朝の散歩", []), ("2023.05.31 石鎚山", [1]), ("『石鎚山』→富士山", [1]),
    ],
)
def test_names(text, numbers):
    assert [n for n, _ in NameList(LIST).resolve(text)] == numbers


def test_spellings():
    assert fold("廣澤之塚") == fold("広沢ノ 塚") and fold("瓶が森") == fold("瓶ヶ森") == fold("瓶ケ森")
    assert romaji("しゃっきん") == "shakkin" and latin("Hōō-zan") == latin("hoozan")


def test_resolved_rows(spark):
    df = spark.createDataFrame([(1, "石鎚山・瓶ヶ森", 0), (1, "石鎚山・瓶ヶ森", 0), (2, "富士山", 0), (3, None, 0), (4, " 　", 0), (None, "石鎚山", 0), (5, "石鎚山" + "あ" * 20_000, 0)], "k long, t string, number int")
    want = [(1, 1), (1, 2), (2, 0), (5, 1)]
    assert rows(resolve_names(df, "k", "t", [LIST]).select("k", "number")) == want
    assert rows(resolve_names(df, "k", "t", [LIST[:1], LIST[1:]]).select("k", "number")) == want  # in blocks
    assert rows(resolve_names(df, "k", "t", []).select("k", "number")) == [(1, 0), (2, 0), (5, 0)]
    assert resolve_names(df.limit(0), "k", "t", [LIST]).collect() == []
    near = [(1, 1, 1, 0), (1, 2, 2, 0), (1, 2, 4, 1), (1, 2, 8, 1), (6, 1, 2, 1), (6, 1, 8, 1)]  # a tie, which names neither, is among all that are near
    tied = df.where("k = 1").unionByName(spark.createDataFrame([(6, "瓶ヶ守", 0)], df.schema))
    for blocks in ([[*LIST, (8, "瓶ヶ盛", None, None)]], [LIST, [(8, "瓶ヶ盛", None, None)]]):
        assert rows(all_within(tied, "k", "t", blocks)) == near
        assert rows(resolve_names(tied, "k", "t", blocks).select("k", "number")) == [(1, 1), (1, 2), (6, 0)]


def test_choices_do_not_depend_on_blocks(spark):
    listed = [(1, "石鎚山", None, "甲"), (2, "石鎚森", None, "甲"), (3, "高森山", None, "乙町"), (4, "高森山", None, "内子町"), (5, "小高森山脈", None, "丙"), (6, "森山", None, None), (7, "高森", None, None)]
    texts = ["石鎚山", "石鎚森", "石鎚峰", "高森山(内子町)", "高森山", "高盛山", "遠くの小高森山脈へ行く道", "高森", "遠い高森山と石鎚森の話", "富士山"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string")
    whole = rows(resolve_names(df, "k", "t", [listed]))
    assert [r[:2] for r in whole if r[0] < 5] == [(0, 1), (1, 2), (2, 1), (2, 2), (3, 4), (4, 3), (4, 4)]
    for n in (1, 2, 3):
        assert rows(resolve_names(df, "k", "t", [listed[i : i + n] for i in range(0, 7, n)])) == whole


def side(spark, data):
    return spark.createDataFrame(data, "id long, tokens array<string>, named boolean, day int, km double, minutes double")


def outings(n, seed, many=False):
    rng = random.Random(seed)
    left, right, want = [], [], set()
    for i in range(n):
        token = f"e{int(rng.paretovariate(0.7)) % 60}"
        day, km, m = (1 if many else rng.randrange(2000)), round(rng.uniform(2, 20), 2), float(rng.randrange(40, 500))
        if rng.random() < 0.85:
            left.append((2 * i, [token], True, None if rng.random() < 0.02 else day, None if rng.random() < 0.05 else km, m))
        if rng.random() < 0.85:
            generic = rng.random() < 0.08
            right.append((2 * i + 1, ["walk"] if generic else [token], not generic, day + (rng.random() < 0.05), round(km * rng.uniform(0.96, 1.04), 1), float(round(m * rng.uniform(0.96, 1.04)))))
        if left and right and left[-1][0] == 2 * i and right[-1][0] == 2 * i + 1:
            want.add((2 * i, 2 * i + 1))
    return left, right, want


def test_matching_of_made_outings(spark):
    left, right, want = outings(700, 1)
    got = {(r.id_a, r.id_b) for r in linked(side(spark, left), side(spark, right)).collect()}
    assert len(got & want) / len(want) > 0.93 and len(got & want) / len(got) > 0.95
    assert len({a for a, _ in got}) == len(got) == len({b for _, b in got})


def test_blocks_hold_all_that_agree(spark):
    left, right, _ = outings(300, 2, many=True)
    left += [(9000, ["e1"], True, 1, None, None), (9002, ["e1"], True, None, 5.0, None), (9004, ["e2"], True, None, None, None)]
    right += [(9001, ["e1"], True, 1, None, 77.0), (9003, ["e2"], True, 1, 5.1, None)]
    p = MatchParameters()
    got = [(r.id_a, r.id_b) for r in matching.candidates(side(spark, left), side(spark, right), p).collect()]

    def agree(x, y, slack, reach):
        return x is None or y is None or abs(np.log(x / y)) <= p.tolerance * reach + slack / max(x, y) * reach

    def met(x, y, reach):
        day = x[3] is not None and y[3] is not None and (abs(x[3] - y[3]) <= 1 if set(x[1]) & set(y[1]) else x[3] == y[3] and not (x[2] and y[2]))
        late = (x[3] is None or y[3] is None) and x[2] and y[2] and set(x[1]) & set(y[1]) and any(x[k] and y[k] for k in (4, 5))
        return (day or late) and agree(x[4], y[4], p.slack_km, reach) and agree(x[5], y[5], p.slack_minutes, reach)

    want = {(x[0], y[0]) for x in left for y in right if met(x, y, 1)}
    assert want <= set(got) <= {(x[0], y[0]) for x in left for y in right if met(x, y, 4)} and len(got) == len(set(got))


def test_a_matched_neighbour_raises(spark):
    edges = [(1, 11, 0.2, "e1", 5, 5), (1, 12, 0.2, "e1", 5, 5), (2, 12, -3.0, "e1", 5, 5), (3, 13, 9.0, "e1", 6, 6), (4, 14, -1.0, "e2", 5, 5), (5, 15, -1.0, "e1", 5, 7)]
    edges += [(100 + i, 200 + i, 6.0, f"x{i // 2}", i % 2, i % 2) for i in range(40)] + [(300 + i, 400 + i, -5.0, "far", 100 + 3 * i, 0) for i in range(40)]
    df = spark.createDataFrame(edges, "id_a long, id_b long, w double, place string, day_a int, day_b int")
    with_, without = ({(r.id_a, r.id_b): r.confidence for r in matching.propagated(d, MatchParameters()).collect()} for d in (df, df.withColumn("place", F.lit(None).cast("string"))))
    assert with_.keys() == without.keys() and with_[1, 11] > without[1, 11] + 0.05  # 3 and 13 match the day after
    assert with_[4, 14] == pytest.approx(without[4, 14]) and with_[5, 15] == pytest.approx(without[5, 15])


def test_matching_of_odd_rows(spark):
    left = [(1, [], False, None, None, None), (2, ["e1"], True, 5, 0.0, -1.0), (3, None, None, None, float("nan"), None)]
    assert linked(side(spark, left), side(spark, left)).count() <= 1
    assert linked(side(spark, []), side(spark, left)).collect() == []
    assert linked(side(spark, left), side(spark, [])).collect() == []


def test_written_measures(spark):
    df = spark.createDataFrame([("8.9 km", "5時間10分"), ("８.３㎞", "03:32"), ("8955 m", "141 min"), (None, None), ("?", "-")], "d string, t string")
    got = [tuple(r) for r in df.select(kilometres(F.col("d")), minutes(F.col("t"))).collect()]
    assert got == [(8.9, 310.0), (8.3, 212.0), (8.955, 141.0), (None, None), (None, None)]
    texts = spark.createDataFrame([("石鎚山・散歩",), ("赤石山",), ("散歩",)], "text string")
    for blocks in ([LIST], [LIST[:5], LIST[5:]]):
        assert {r.text: (set(r.tokens), r.named) for r in tokens_of(texts, blocks).collect()} == {"石鎚山・散歩": ({"e1", "散歩"}, True), "赤石山": ({"e5"}, True), "散歩": ({"散歩"}, False)}


def test_ids_against_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(DEFAULT_VOCABULARY)
    library.encode_special_tokens = True
    rng = random.Random(0)
    texts = ["", " ", "\n\n  a", "Don't we'll I'd THEY'RE", "<|endoftext|>", "aaaa" * 300, "山" * 900, "x" * 9000, "áé​😀👍🏽", "\x00\x01", "日本語とEnglishの混在、12345 ½ Ⅷ"]
    texts += ["".join(rng.choice("ab cあい山0 .,!\n\t'") for _ in range(rng.randrange(200))) for _ in range(300)]
    ids, offsets = merges(DEFAULT_VOCABULARY).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "a")], "doc long, text string")
    assert rows(encoded(df, "doc", "text")) == sorted([(1, library.encode("a b").ids)] * 2 + [(2, []), (3, []), (None, library.encode("a").ids)], key=str)
    assert encoded(df.limit(0), "doc", "text").collect() == []


def test_ids_when_the_words_are_forgotten(monkeypatch):
    model = merges(DEFAULT_VOCABULARY)
    whole = model.encode(["one two three", "two"])[0].tolist()
    monkeypatch.setattr(tokenizer, "KNOWN_WORDS", 0)
    monkeypatch.setattr(tokenizer, "FLAT", 3)
    assert model.encode(["one two three"])[0].tolist() + model.encode(["two"])[0].tolist() == whole


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6))
def test_search_against_all_windows(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    items = [(k, word(rng.randrange(5, 60))) for k in range(4)]
    texts = []
    for _ in range(6):
        _, item = rng.choice(items)
        a = rng.randrange(len(item))
        texts.append(word(rng.randrange(40)) + item[a : a + rng.randrange(4, 40)] + word(rng.randrange(40)))
    size = 10
    want = [{k for k, item in items for s in range(len(item) - size + 1) if item[s : s + size] in t} for t in texts]
    assert Patterns(items, size).search(texts) == want


def test_repeating_texts_are_quick():
    found = Patterns([(i, "a" * 500) for i in range(50)]).search(["a" * 4000] * 3 + ["b"])  # each hit is one of all places of all items
    assert [len(f) for f in found] == [50, 50, 50, 0]


def test_leaks(spark, monkeypatch):
    passage = "".join(chr(0x4E00 + i * 7 % 800) for i in range(80))
    broken = "\n> ".join(passage[i : i + 9] for i in range(0, 80, 9)).replace(passage[20], passage[20] + "​…")
    docs = spark.createDataFrame([(1, "x" + passage), (2, broken), (3, passage[:49]), (4, None), (5, ""), (6, "長" * 60_000 + passage[10:60]), (1, "x" + passage), (None, passage)], "doc long, text string")
    items = spark.createDataFrame([(7, passage), (7, passage), (8, passage[:40]), (9, None), (None, passage)], "item long, words string")
    want = [(1, 7), (2, 7), (6, 7)]
    assert rows(leaks(docs, "doc", "text", items, "item", "words")) == want
    monkeypatch.setattr(leakage, "BLOCK_CHARACTERS", 10)
    assert rows(leaks(docs, "doc", "text", items, "item", "words")) == want
    assert leaks(docs, "doc", "text", items.limit(0), "item", "words").collect() == []
    assert leaks(docs.limit(0), "doc", "text", items, "item", "words").collect() == []
    assert letters_and_digits("Ａb-Ｃ １​。") == "abc1"


PROSE = "送電線の鉄塔を過ぎると急に展望が開けるので、ゆっくり歩く。山頂で温かいお茶を食べて21分休む。\n"
GOODS = ["登山靴", "セール", "通販", "格安", "送料無料", "寝袋", "クーポン", "最安値"], ["outlet", "coupon", "wholesale", "discount", "cheap", "backpack", "shipping"]


@pytest.fixture(scope="session")
def model():
    """Learned from made pages: diaries in two languages, and fillers of several kinds."""
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("甲乙丙丁戊藍凪楓柱紅鴨狸") for _ in range(2)) + rng.choice("山森岳")
    pages = []
    for i in range(160):
        diary = "".join(f"{name()}の尾根を{rng.randrange(90)}分歩いて、{rng.choice(['風が強い', '沢音が近い', '花が見頃だ', '霧が晴れた'])}。" for _ in range(6))
        pages += [diary, diary.replace("。", "。\n") + "鳥類\nヒガラ、アオバト、メジロ、イカル、トビ", "We left the car park early and reached the ridge. The wind was cold near the top. " * 2, f"コース: {name()} 6:28 → {name()} 9:10"]
        goods = GOODS[i % 2]
        pick = lambda n: [rng.choice(goods) for _ in range(n)]  # noqa: B023, E731
        pages.append(["\n".join(f"https://shop{rng.randrange(99)}.example/p/{rng.randrange(999)}" for _ in range(9)), " | ".join(pick(25)), "\n".join(" ".join(pick(4)) + " " + name() for _ in range(12)), " ".join("#" + x for x in pick(18)), " / ".join(f"{name()} {goods[i % 7]}" for _ in range(14))][i % 5])
    return learned(pages)


def test_what_is_learned(model):
    assert {"セール", "通販", "outlet", "coupon"} <= model.sold and not model.sold & {"ヒガラ", "メジロ", "ridge", "尾根"}
    assert np.allclose(np.exp(model.emission).sum(1), 1) and np.allclose(np.exp(model.change).sum(1), 1)
    assert np.exp(model.emission)[0, SYMBOLS.index("S")] > 0.5


@pytest.mark.parametrize(
    "text, is_filler",
    [
        (PROSE * 3, False), ("", False), (" \n", False), ("登山靴 | セール | 通販 | 登山靴 | 格安 | セール | 登山靴 | 通販 | 格安 | 登山靴", True), ("\n".join(f"https://shop{i}.example/p/{i}" for i in range(9)), True),
        (PROSE + "参考:\n- https://a.example/p/1\n- https://b.example/p/2", False), ("■鳥類\nヒガラ、アオバト、シジュウカラ、メジロ、イカル、トビ、カケス、ウグイス、キビタキ\n" + PROSE, False), (PROSE + "#鳥 #秋", False),
        ("#セール #登山靴 #甲山 #通販 " * 12, True), ("今すぐ通販、甲山も通販通販、とにかく通販。通販なら通販専門の通販、乙山の通販も通販。" * 3, True), ("For review think review, X review and review. " * 5, True),
        ("\n".join(f"{a}山格安" for a in "甲乙丙丁戊己庚辛"), True), ("【コース】甲山 6:28 → 乙山 14:53 → 丙森 8:54\n" + PROSE, False), ("cheaptrekkingpolescoupon" * 30, True), ("あ" * 30_000, False), (PROSE * 3 + "セール、セール、セール、セール", False),
        ("\n".join(["Walking down the river road", "The morning light is calling me", "Oh sing with me my mountain love", "Oh sing with me tonight", "Oh sing with me my mountain love"] * 3), False),
        ("\n".join(["夕焼けの空を見上げて", "帰り道を歩いてゆく", "ああ ふるさとの山よ", "ああ ふるさとの川よ"] * 3), False),
        ("\n".join(f"{a}: a small bird of the forest with a long tail and a loud song" for a in "wren tit finch thrush robin owl dipper crow jay lark".split()), False),
        ("今すぐｾｰﾙ、甲山もｾｰﾙｾｰﾙ、とにかくｾｰﾙ。" * 4, True), ("> how far in steps of\n> 12 was the stone road\n>  from the bridge post\n> s and the fence of the\n> old sign" + "\n" + PROSE, False),
    ],
)
def test_fillers(text, is_filler, model):
    assert (other_share(text, model) > 0.5) is is_filler


def test_labels(model):
    assert label("") == [] and label("SSSUUUUSSS") == ["prose"] * 3 + ["links"] * 4 + ["prose"] * 3
    parts = units("a" * 5000)
    assert "".join(parts) == "a" * 5000 and len(symbols(parts, model.sold)) == len(parts)
    best = max(itertools.product(range(4), repeat=4), key=lambda p: Model().start[p[0]] + sum(Model().change[a, b] for a, b in zip(p, p[1:])) + sum(Model().emission[s, SYMBOLS.index(c)] for s, c in zip(p, "SKTO")))
    assert label("SKTO") == [STATES[s] for s in best]


def test_expected_counts_against_all_paths():
    m, signs = Model(), "SKTR"
    chance = {p: np.exp(m.start[p[0]] + sum(m.change[a, b] for a, b in zip(p, p[1:])) + sum(m.emission[s, SYMBOLS.index(c)] for s, c in zip(p, signs))) for p in itertools.product(range(4), repeat=4)}
    total = sum(chance.values())
    start, moves, counts, states = posteriors([signs, "S", signs], m)
    want = np.zeros((4, 4))
    for p, c in chance.items():
        for a, b in zip(p, p[1:]):
            want[a, b] += c / total
    one = posteriors(["S"], m)
    assert np.allclose(moves, 2 * want) and np.allclose(states[0].sum(0) * 2 + one[3][0].sum(0), counts.sum(1))
    assert np.allclose(states[2][2], [sum(c for p, c in chance.items() if p[2] == s) / total for s in range(4)])


def test_filler_rows(spark):
    spam = "登山靴 | セール | " * 20
    df = spark.createDataFrame([(1, spam), (1, spam), (2, PROSE), (3, None), (4, ""), (None, spam)], "doc long, text string")
    assert [r.doc for r in filler(df, "doc", "text").collect()] == [1, 1]
    assert filler(df.limit(0), "doc", "text").collect() == []


def test_equal_records_need_few_rounds(spark, monkeypatch):
    looks = []
    monkeypatch.setattr(matching, "cut_lineage", lambda df: looks.append(1) or (df.checkpoint() if len(looks) < 40 else pytest.fail("too many rounds over all edges")))
    spark.sparkContext.setCheckpointDir(spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="tarn-checkpoint-"))
    left, right, _ = outings(60, 3)
    left += [(5000 + i, ["e7"], True, 77, 5.0, 100.0) for i in range(30)] + [(6000, ["e8"], True, 90, 6.0, 120.0), (6010, ["e8"], True, 90, 6.0, 120.0)]
    right += [(7001 + i, ["e7"], True, 77, 5.0, 100.0) for i in range(30)] + [(6001, ["e8"], True, 90, 6.0, 120.0)]
    got = {(r.id_a, r.id_b) for r in linked(side(spark, left), side(spark, right)).collect()}
    assert not any(a in range(5000, 5030) for a, _ in got) and len(got) > 30 and (6010, 6001) not in got


def test_messages_in_one_task_or_many(spark):
    rng = random.Random(4)
    edges = [(a, 1000 + b, rng.uniform(-2, 6), None, 1, 1, 1 + a % 3, 1 + b % 4) for part in range(12) for a in range(part * 9, part * 9 + 9) for b in range(part * 9, part * 9 + 9) if rng.random() < 0.4]
    df = spark.createDataFrame(edges, "id_a long, id_b long, w double, place string, day_a int, day_b int, n_a int, n_b int")
    alone = spark.createDataFrame([(a * 10 + i, b * 10 + j, *rest) for a, b, *rest, n, m in edges for i in range(n) for j in range(m)], "id_a long, id_b long, w double, place string, day_a int, day_b int")
    many, one, each = ({(r.id_a, r.id_b): r.confidence for r in matching.propagated(d, p).collect()} for d, p in ((df, MatchParameters(local_edges=0)), (df, MatchParameters(shared_rounds=3)), (alone, MatchParameters())))
    assert many.keys() == one.keys() and all(abs(many[k] - one[k]) < 2e-3 for k in many)
    assert all(abs(c - many[a // 10, b // 10]) < 2e-3 for (a, b), c in each.items())


def test_fillers_are_learned_from_all_rows(spark, monkeypatch):
    rng = random.Random(8)
    prose = [(i, "".join(f"{rng.choice('甲乙丙丁戊藍凪楓')}の尾根を{rng.randrange(90)}分歩いて、風が強い。" for _ in range(5))) for i in range(1700)]
    goods = ["登山靴", "セール", "通販", "格安", "寝袋", "クーポン", "最安値"]
    spam = [(5000 + i, " | ".join(rng.choice(goods) for _ in range(25))) for i in range(30)] + [(6000, PROSE), (6001, " "), (6002, None)]
    df = spark.createDataFrame(prose + spam, "doc long, text string").repartition(3)
    seen = []
    own = fillers.maximised
    monkeypatch.setattr(fillers, "maximised", lambda expected, *rest: own(lambda m: seen.append(expected(m)) or seen[-1], *rest))
    got = {r.doc: r.share for r in filler(df, "doc", "text").collect()}
    assert round(seen[0][0].sum()) == round(seen[-1][0].sum()) == len(prose) + len(spam) - 2  # one start for each text that isn't blank
    model = learned([t for _, t in prose + spam if t])
    want = {k: share for k, t in prose + spam if t and (share := other_share(t, model)) > 0.5}
    assert got == pytest.approx(want) and set(got) == set(range(5000, 5030))
