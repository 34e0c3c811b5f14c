import ast
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewell.functions.text import nested_names, tokenize, word_ngrams
from tidewell.plans.content import set_aside


def kind(ch):
    if "가" <= ch <= "힣":
        return "hangul"
    if "ㄱ" <= ch <= "ㅎ" or "ㅏ" <= ch <= "ㅣ" or ch == "|":
        return "jamo"
    if ch in "abcdefghijklmnopqrstuvwxyz0123456789-":
        return "latin"
    return "plus" if ch == "+" else "other"


def expected(text):
    """Plain restatement of the token rule, character by character."""
    tokens = []
    for word in text.lower().split():
        for name, run in groupby(word, kind):
            if name == "other":
                tokens.extend(run)
            elif name != "plus":
                tokens.append("".join(run))
    return tokens


def run(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", column.alias("t")).collect()
    return [r["t"] for r in sorted(rows)]


CASES = {
    "갤럭시 중고폰": ["갤럭시", "중고폰"],
    "연예인 지갑 지갑": ["연예인", "지갑", "지갑"],
    "갤럭시s10 갤럭시북 NT950XDZ-G58AW 중고폰": ["갤럭시", "s10", "갤럭시북", "nt950xdz-g58aw", "중고폰"],
    "C++ a+b |||ㅋㅋ!! --": ["c", "a", "b", "|||ㅋㅋ", "!", "!", "--"],
    "": [],
    "+ ++": [],
    "a\tb\nc d　e f": list("abcdef"),
}


def test_token_goldens(spark):
    assert run(spark, list(CASES), tokenize(F.col("x"))) == list(CASES.values())


def test_symbol_runs_can_stay_together(spark):
    assert run(spark, ["wow!!? ok"], tokenize(F.col("x"), group_symbols=True)) == [["wow", "!!?", "ok"]]


LETTERS = st.sampled_from("aZ09-+|!가힣ㄱㅎㅏㅣ \t\n 　éß€😀#.")
ANY = st.characters(min_codepoint=0, max_codepoint=0x1C00, exclude_categories=("Cs",))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.one_of(LETTERS, ANY), max_size=40), min_size=1, max_size=80))
def test_tokens_of_random_text(spark, texts):
    assert run(spark, texts, tokenize(F.col("x"))) == [expected(t) for t in texts]


def test_every_space_separates(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert run(spark, [f"a{s}b" for s in spaces], tokenize(F.col("x"))) == [["a", "b"]] * len(spaces)


def test_ngrams(spark):
    got = run(spark, ["Action Science Fiction x", "one", "a b", "액션 été_1"], word_ngrams(F.col("x")))
    assert got[0] == ["action", "science", "fiction", "action science", "science fiction", "action science fiction"]
    assert got[1:] == [["one"], [], ["액션", "été_1", "액션 été_1"]]


def test_nested_names(spark):
    cells = ['[{"id": 28, "name": "Action"}, {"id": 12, "name": "Men\'s"}]', "[{'id': 1, 'name': 'Drama'}]", "[]"]
    assert run(spark, cells, nested_names(F.col("x"))) == ["Action Men's", "Drama", ""]
    with pytest.raises(Exception, match="[Mm]alformed"):
        run(spark, ["[{oops"], nested_names(F.col("x")))


def read_literal(cell):
    """What the names of a cell are by Python's own reader; null where it is no list of dicts."""
    try:
        value = ast.literal_eval(cell)
    except (ValueError, SyntaxError):
        return None
    if not isinstance(value, list) or not all(isinstance(x, dict) for x in value):
        return None
    return " ".join(str(x["name"]) for x in value if x.get("name") is not None)


LITERALS = [
    "[{'id': 1, 'name': 'Drama', 'parent': None}, {'name': \"Men's\", 'adult': True, 'x': False}]", r"[{'name': 'it\'s \"q\"'}]",
    r"[{'name': 'a\\b\n\t\x41\u00e9\U0001F600\101\q\a'}]", "[{'name': 'x'},]", "[,]", "[{'name': 'a'},,]", "[{oops", "[] x", "[]}, []", "[], []",
    "[] ]", "", " ", "{'name': 'x'}", "[1]", "[{'name': 'a\nb'}]", "[{'name': 'tab\there'}]", "[{'name': None}, {'name': 'z'}]",
    r"[{'name': '\x4'}]", "[{'name': 'None True, ]'}]", r"[{'name': 'end\\'}]", r"[{'name': 'q\'}]", r"[{'name': '\']", "[{'name': 'a'}]\\",
    "[(1, 2)]", "[{'name': 3}]", "[{'name': 'a\x01b'}]", "[{'name': 'a', 'n': [1, -2.5e3, {'k': 'v'}]}]", "[{'name': 'a' : 'b'}]", "[None]",
    "  [{'name': 'a'}]", "[{'name': 'ab" + "\\\\" * 20_000 + "'}]",
]


def test_literals_of_python(spark):
    got = run(spark, LITERALS, nested_names(F.col("x"), "null"))
    want = [read_literal(cell.lstrip()) for cell in LITERALS]
    assert got == want


names = st.text(st.one_of(st.sampled_from("'\"\\nux0\t,[]{}: é😀"), st.characters(exclude_categories=("Cs",), max_codepoint=0x10FFF)), max_size=12)
values = st.one_of(st.none(), st.booleans(), st.integers(-(2**40), 2**40), st.floats(allow_nan=False, allow_infinity=False), names)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.fixed_dictionaries({"id": values, "name": names, "more": st.lists(values, max_size=2)}), max_size=3), min_size=1, max_size=40))
def test_written_literals_are_read_again(spark, cells):
    got = run(spark, [repr(cell) for cell in cells], nested_names(F.col("x")))
    assert got == [" ".join(x["name"] for x in cell) for cell in cells]


def test_unreadable_rows_are_set_aside(spark):
    rows = [(1, "[{'name': 'a'}]", None), (2, "[{'name': 'a'}]", "[{"), (3, "None", "[]"), (4, "[]", "[{'name': None}]")]
    good, bad = set_aside(spark.createDataFrame(rows, "id int, genres string, keywords string"))
    assert sorted(r["id"] for r in good.collect()) == [1, 4] and sorted(r["id"] for r in bad.collect()) == [2, 3]
