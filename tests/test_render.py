"""Golden rows: each input with its whole expected text."""

from time import monotonic

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.render import render_text
from corpusloom.functions.text import WHITESPACE, last_split, strip, stripped_length
from corpusloom.spec import SourceSpec


def render(spark, row, schema, **spec):
    rows = spark.createDataFrame([row], schema)
    return rows.select(render_text(rows, SourceSpec("s", **spec)).alias("t")).first()["t"]


PLAIN = {"text_field": "text"}
QA = {"text_field": "question", "answer_field": "answer"}
REASON = {**QA, "format": "reasoning"}
SYSTEM = {**REASON, "system_field": "system"}
CHAT = {"text_field": "messages"}
PAIR = "question string, answer string"
TRIPLE = "question string, answer string, system string"
TALK = "messages array<struct<role: string, content: string>>"
MAPS = "messages array<map<string, string>>"


def user(question, answer, system=None):
    lead = f"<|system|>\n{system}\n" if system else ""
    return f"{lead}<|user|>\n{question}\n<|assistant|>\n{answer}\n<|end|>"


GOLDEN = {
    "plain": (("Rain fell on the harbour all night.",), "text string", PLAIN, "Rain fell on the harbour all night."),
    "pair": (("How many legs has a spider?", "8"), PAIR, QA, user("How many legs has a spider?", "8")),
    "reasoning": (("Name the colour of a ripe lemon.", "A ripe lemon is yellow."), PAIR, REASON,
                  user("Name the colour of a ripe lemon.", "A ripe lemon is yellow.")),
    "final answer": (
        ("A shelf holds 9 jars and 6 are sold; what is left?", "Nine jars less six jars: 9 - 6 = 3 jars. #### 3 jars"),
        PAIR, REASON,
        user("A shelf holds 9 jars and 6 are sold; what is left?",
             "<think>\nNine jars less six jars: 9 - 6 = 3 jars.\n</think>\n\nThe answer is: 3 jars")),
    "boxed": (
        ("Which y gives 7y = 63?", "Both sides over seven leave y = \\boxed{9}"), PAIR, REASON,
        user("Which y gives 7y = 63?",
             "<think>\nBoth sides over seven leave y = \\boxed{9}\n</think>")),
    "system": (("Where does the Elbe rise?", "In the Giant Mountains", "Reply like a hiking guide."), TRIPLE, SYSTEM,
               user("Where does the Elbe rise?", "In the Giant Mountains", "Reply like a hiking guide.")),
    "chat": (([("user", "Is the mill open?"), ("assistant", "From nine on.")],), TALK, CHAT,
             "<|user|>\nIs the mill open?\n<|assistant|>\nFrom nine on.\n<|end|>"),
    "empty text": (("",), "text string", PLAIN, ""),
    "no column": (("unused",), "remark string", PLAIN, ""),
    "no question": (("", "an answer alone"), PAIR, REASON, ""),
    "no answer": (("a question alone", ""), PAIR, REASON, ""),
    "null answer": (("a question alone", None), PAIR, REASON, ""),
    "no answer column": (("a question alone",), "question string", REASON, ""),
    "empty chat": (([],), TALK, CHAT, "\n<|end|>"),
    "long chat": (
        ([("user", "Tea?"), ("assistant", "Please."), ("user", "With milk?"), ("assistant", "Just lemon, if there's any.")],),
        TALK, CHAT,
        "<|user|>\nTea?\n<|assistant|>\nPlease.\n<|user|>\nWith milk?\n<|assistant|>\nJust lemon, if there's any.\n<|end|>"),
    "null text": ((None,), "text string", PLAIN, "None"),
    "number": ((-8070,), "text int", PLAIN, "-8070"),
    "true": ((True,), "text boolean", PLAIN, "True"),
    "special": (("a < b && \"c\" > 'd' \\r \\x",), "text string", PLAIN, "a < b && \"c\" > 'd' \\r \\x"),
    "unicode": (("\u6c34 \u0436\u0443\u043a \u05d0 \U0001F9ED",), "text string", PLAIN,
                "\u6c34 \u0436\u0443\u043a \u05d0 \U0001F9ED"),
    "two marks": (("How tall is the mast?", "hull 4 #### deck 6 #### 10 metres"), PAIR, REASON,
                  user("How tall is the mast?", "<think>\nhull 4 #### deck 6\n</think>\n\nThe answer is: 10 metres")),
    "very long": (("x" * 100_000,), "text string", PLAIN, "x" * 100_000),
    "five hashes": (("q", "a#####b"), PAIR, REASON, user("q", "<think>\na#\n</think>\n\nThe answer is: b")),
    "mark before box": (("q", "\\boxed{1} #### 1"), PAIR, REASON,
                        user("q", "<think>\n\\boxed{1}\n</think>\n\nThe answer is: 1")),
    "box not stripped": (("q", " \\boxed{1} "), PAIR, REASON, user("q", "<think>\n \\boxed{1} \n</think>")),
    "empty system": (("q", "a", ""), TRIPLE, SYSTEM, user("q", "a")),
    "null system": (("q", "a", None), TRIPLE, SYSTEM, user("q", "a")),
    "no system column": (("q", "a"), PAIR, SYSTEM, user("q", "a")),
    "pair, null answer": (("q", None), PAIR, QA, user("q", "None")),
    "pair, empty answer": (("q", ""), PAIR, QA, user("q", "")),
    "pair, no answer column": (("q",), "question string", QA, "q"),
    "reasoning without answer field": (("q", "a"), PAIR, {"text_field": "question", "format": "reasoning"}, "q"),
    "null messages": ((None,), TALK, CHAT, "None"),
    "messages not a list": (("hello",), "messages string", CHAT, "hello"),
    "null messages, reasoning": ((None, "a"), f"{TALK}, answer string",
                                 {**CHAT, "answer_field": "answer", "format": "reasoning"}, ""),
    "map without role": (([{"content": "hi"}],), MAPS, CHAT, "<|user|>\nhi\n<|end|>"),
    "map without content": (([{"role": "bot"}],), MAPS, CHAT, "<|bot|>\n\n<|end|>"),
    "map with null role": (([{"role": None, "content": "hi"}],), MAPS, CHAT, "<|None|>\nhi\n<|end|>"),
    "struct with null role": (([(None, "hi")],), TALK, CHAT, "<|None|>\nhi\n<|end|>"),
    "struct without role": (([("hi",)],), "messages array<struct<content: string>>", CHAT, "<|user|>\nhi\n<|end|>"),
    "only a final answer": (("q", "#### 7"), PAIR, REASON, user("q", "<think>\n\n</think>\n\nThe answer is: 7")),
    "zero is no question": ((0, "a"), "question int, answer string", REASON, ""),
    "number as answer": (("q", 7), "question string, answer int", REASON, user("q", "7")),
    "zero is no answer": (("q", 0.0), "question string, answer double", REASON, ""),
    "false is no answer": (("q", False), "question string, answer boolean", REASON, ""),
    "true as answer": (("q", True), "question string, answer boolean", REASON, user("q", "True")),
}


@pytest.mark.parametrize("case", GOLDEN)
def test_golden(spark, case):
    row, schema, spec, expected = GOLDEN[case]
    assert render(spark, row, schema, **spec) == expected


def test_chat_of_plain_strings_is_refused(spark):
    with pytest.raises(ValueError):
        render(spark, (["a"],), "messages array<string>", **CHAT)


def test_no_python_in_the_plan(spark, capsys):
    rows = spark.createDataFrame([("q", "a", "s")], TRIPLE)
    rows.select(render_text(rows, SourceSpec("s", **SYSTEM))).explain()
    assert "Python" not in capsys.readouterr().out.replace("Scan ExistingRDD", "")


def test_strip_is_pythons(spark):
    assert len(WHITESPACE) == 29
    cases = [f"{c}x{c}" for c in WHITESPACE] + [WHITESPACE, "", "a b", " \u200b ", "\ufeffx", "\u4e2d "]
    rows = spark.createDataFrame([(c,) for c in cases], "text string")
    got = rows.select("text", strip(F.col("text")).alias("s"), stripped_length(F.col("text")).alias("n")).collect()
    assert [(r.s, r.n) for r in got] == [(r.text.strip(), len(r.text.strip())) for r in got]


def test_last_split_is_rsplit(spark):
    cases = ["a#####b", "####", "########", "a####", "####b", "a #### b #### c", "\U0001F600####\u4e2d"]
    rows = spark.createDataFrame([(c,) for c in cases], "text string")
    left, right = last_split(F.col("text"), "####")
    for r in rows.select("text", left.alias("l"), right.alias("r")).collect():
        assert [r.l, r.r] == r.text.rsplit("####", 1)




def test_numbers_are_spelled_quickly(spark):
    """A hundred thousand numbers of all magnitudes, in some seconds; 17 and 18 digits of the JVM are cut to what is needed."""
    odd = [0.0, -0.0, 2.0**-44, 1e16, 9999999999999998.0, 1e-4, 9.999999999999999e-05, 1e7, 9999999.999999998, 5e-05, 1e22, 123456789.0,
           float("inf"), float("-inf"), 1.7976931348623157e308, -1.6210920517178982e18, 0.1 + 0.2, 1.7835440000000002e-05]
    rows = spark.createDataFrame([(v, repr(v)) for v in odd], "text double, wanted string")
    got = rows.select("text", "wanted", render_text(rows, SourceSpec("s")).alias("t")).collect()
    assert [r.t for r in got] == [r.wanted for r in got]
    many = spark.range(0, 800_000, 1, 8).select((F.pow(F.lit(10.0), F.col("id") % 30 - 9) * (F.col("id") + 0.37)).alias("text"))
    rendered = many.select(render_text(many, SourceSpec("s")).alias("t"))
    began = monotonic()
    assert rendered.where("t = 'None' OR t = '' OR cast(t AS double) IS NULL").isEmpty()
    assert monotonic() - began < 20
