"""Row renderer: one native Column per source turns a raw row into training text.

Which columns exist and what type they have is known while the plan is built, so
those choices are made once per source; only choices on values stay in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import last_split, py_str, strip, truthy
from corpusloom.spec import SourceSpec

# Markers of the rendered text.
END = "<|end|>"
ANSWER_MARK = "####"
BOX_MARK = "\\boxed{"
CHAT_FIELD = "messages"


def _block(role: str, body: Column) -> Column:
    return F.concat(F.lit(f"<|{role}|>\n"), body)


def _think(body: Column) -> Column:
    return F.concat(F.lit("<think>\n"), body, F.lit("\n</think>"))


def _message_part(message: Column, dtype: T.DataType, name: str, default: str) -> Column:
    """A message's role or content as text, with its default where the key is missing."""
    if isinstance(dtype, T.StructType):
        # A typed struct always has its declared fields, so null is a value.
        if name not in dtype.fieldNames():
            return F.lit(default)
        return py_str(message[name], dtype[name].dataType)
    return F.when(F.map_contains_key(message, name), py_str(message[name], dtype.valueType)).otherwise(F.lit(default))


def render_chat(messages: Column, element: T.DataType) -> Column:
    """Messages as ``<|role|>`` blocks, closed by the end marker."""
    if not isinstance(element, (T.StructType, T.MapType)):
        raise ValueError(f"chat messages must be structs or maps, not {element.simpleString()}")

    def block(message: Column) -> Column:
        role = _message_part(message, element, "role", "user")
        content = _message_part(message, element, "content", "")
        return F.concat(F.lit("<|"), role, F.lit("|>\n"), content)

    return F.concat(F.array_join(F.transform(messages, block), "\n"), F.lit("\n" + END))


def render_answer(answer: Column) -> Column:
    """A reasoning answer: final-answer split, boxed answer, or the answer as it is."""
    steps, final = last_split(answer, ANSWER_MARK)
    split = F.concat(_think(strip(steps)), F.lit("\n\nThe answer is: "), strip(final))
    return (
        F.when(F.contains(answer, F.lit(ANSWER_MARK)), split)
        .when(F.contains(answer, F.lit(BOX_MARK)), _think(answer))
        .otherwise(answer)
    )


def render_text(rows: DataFrame, spec: SourceSpec) -> Column:
    """The text of each row of ``rows`` under ``spec``; never null."""
    types = {f.name: f.dataType for f in rows.schema.fields}

    def text_of(name: str) -> Column:
        return py_str(F.col(f"`{name}`"), types[name])

    def has_value(name: str) -> Column:
        return truthy(F.col(f"`{name}`"), types[name]) if name in types else F.lit(False)

    field, answer, system = spec.text_field, spec.answer_field, spec.system_field
    if spec.is_reasoning:
        if field not in types or answer not in types:
            rest = F.lit("")
        else:
            # concat_ws skips nulls, which leaves out an empty system block.
            blocks = [F.when(has_value(system), _block("system", text_of(system)))] if system in types else []
            blocks += [_block("user", text_of(field)), _block("assistant", render_answer(text_of(answer))), F.lit(END)]
            rest = F.when(has_value(field) & has_value(answer), F.concat_ws("\n", *blocks)).otherwise(F.lit(""))
    elif field not in types:
        rest = F.lit("")
    elif answer and answer in types:
        rest = F.concat_ws("\n", _block("user", text_of(field)), _block("assistant", text_of(answer)), F.lit(END))
    else:
        rest = text_of(field)

    if field == CHAT_FIELD and isinstance(types.get(field), T.ArrayType):
        messages = F.col(f"`{field}`")
        return F.when(messages.isNotNull(), render_chat(messages, types[field].elementType)).otherwise(rest)
    return rest
