"""Strict JSON found inside free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline.functions.text import last_index, strip

_FENCE = "```"


def _between(text: Column, opener: str, closer: str) -> Column:
    start = F.instr(text, opener)
    end = last_index(text, closer)
    found = F.when(end > start, F.substring(text, start, end - start + F.lit(1)))
    # The byte search of contains() is much faster than counting places
    return F.when(F.contains(text, F.lit(opener)), found)


def candidate(text: Column) -> Column:
    """Body of the first fenced block, else first '{' to last '}', else '[' to ']'."""
    open_at = F.instr(text, _FENCE)
    close_at = F.position(F.lit(_FENCE), text, open_at + F.lit(3))
    body = F.substring(text, open_at + F.lit(3), close_at - open_at - F.lit(3))
    body = strip(F.regexp_replace(body, F.lit(r"(?iu)\Ajson"), F.lit("")))
    fenced = F.when(F.contains(text, F.lit(_FENCE)), F.when(close_at > 0, body))
    return F.coalesce(fenced, _between(text, "{", "}"), _between(text, "[", "]"))


# The JSON token grammar (RFC 8259) and the three constants that
# Python's json module takes as numbers (NaN, Infinity, -Infinity).
_STRING = r'"[^"\\\x00-\x1F]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1F]*+)*+"'
_NUMBER = r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
_CONSTANTS = ("NaN", "Infinity", "-Infinity")
#: Every token; a character that starts none is a token of one character, which
#: the recogniser refuses. White space between tokens is skipped.
_TOKEN = rf"{_STRING}|{_NUMBER}|true|false|null|NaN|-?Infinity|[^\x20\x09\x0A\x0D]"

# What the automaton expects next.
_VALUE, _KEY_OR_CLOSE, _COLON, _AFTER, _KEY, _ITEM_OR_CLOSE = range(6)


def tokens(c: Column) -> Column:
    """The tokens of a text, white space left out; possessive, so long runs never backtrack."""
    return F.regexp_extract_all(c, F.lit(_TOKEN), 0)


def _kind(t: Column, constants: bool) -> Column:
    """p: one of {}[]:, as itself; s: a string; v: any other value; x: no token."""
    one = F.length(t) == 1
    scalar = t.isin("true", "false", "null") | (F.lit(constants) & t.isin(*_CONSTANTS))
    return (
        F.when(one & t.isin("{", "}", "[", "]", ":", ","), t)
        .when(one & t.rlike("^[0-9]$"), F.lit("v"))
        .when(one, F.lit("x"))
        .when(F.substring(t, 1, 1) == '"', F.lit("s"))
        .when(scalar, F.lit("v"))
        .when(t.isin(*_CONSTANTS), F.lit("x"))
        .otherwise(F.lit("v"))
    )


def _transitions(stack: Column, expect: Column, kind: Column) -> list[tuple[Column, Column, Column]]:
    """The moves of the pushdown automaton: (when, next stack, next expectation).

    The stack is a string of open brackets. After the one top-level value
    (``_AFTER`` with an empty stack) no move is left.
    """
    top = F.substring(stack, -1, 1)
    pop = F.substring(stack, F.lit(1), F.length(stack) - 1)
    opens_value = expect.isin(_VALUE, _ITEM_OR_CLOSE)
    return [
        (kind.isin("{", "[") & opens_value, F.concat(stack, kind), F.when(kind == "{", _KEY_OR_CLOSE).otherwise(_ITEM_OR_CLOSE)),
        (kind.isin("s", "v") & opens_value, stack, F.lit(_AFTER)),
        ((kind == "s") & expect.isin(_KEY_OR_CLOSE, _KEY), stack, F.lit(_COLON)),
        ((kind == ":") & (expect == _COLON), stack, F.lit(_VALUE)),
        ((kind == ",") & (expect == _AFTER) & (top == "{"), stack, F.lit(_KEY)),
        ((kind == ",") & (expect == _AFTER) & (top == "["), stack, F.lit(_VALUE)),
        ((kind == "}") & ((expect == _KEY_OR_CLOSE) | ((expect == _AFTER) & (top == "{"))), pop, F.lit(_AFTER)),
        ((kind == "]") & ((expect == _ITEM_OR_CLOSE) | ((expect == _AFTER) & (top == "["))), pop, F.lit(_AFTER)),
    ]


def _step(state: Column, kind: Column) -> Column:
    """One move of the automaton as one CASE; a refused token leaves ``ok`` false for good."""
    stack, expect = state["stack"], state["expect"]
    out = F.when(~state["ok"], state)
    for when, to_stack, to_expect in _transitions(stack, expect, kind):
        out = out.when(when, F.struct(to_stack.alias("stack"), to_expect.alias("expect"), F.lit(True).alias("ok")))
    return out.otherwise(F.struct(stack.alias("stack"), expect.alias("expect"), F.lit(False).alias("ok")))


def recognised(c: Column, constants: bool = True, ts: Column | None = None) -> Column:
    """Whether the whole text is exactly one JSON value, as Python's json.loads reads it.

    Nothing is parsed into a value and nothing is shortened: strings, keys and
    numbers of any length, and texts of any size, are judged alike. With
    ``constants``, NaN, Infinity and -Infinity are numbers, as in Python. The
    nesting depth has no limit here (CPython stops near 1,000 levels). ``ts``
    may hold ``tokens(c)`` already, bound in an earlier projection.
    """
    kinds = F.transform(tokens(c) if ts is None else ts, lambda t: _kind(t, constants))
    start = F.struct(F.lit("").alias("stack"), F.lit(_VALUE).alias("expect"), F.lit(True).alias("ok"))
    whole = lambda end: end["ok"] & (end["expect"] == _AFTER) & (F.length(end["stack"]) == 0)
    return F.when(F.isnotnull(c), F.aggregate(kinds, start, _step, whole))


#: The reader of members takes strings of any length.
_READ = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1), "allowNonNumericNumbers": "true"}


def _marked(ts: Column, constants: bool) -> Column:
    """The text with every string value prefixed by S and every other scalar made "N".

    Keys (strings followed by a colon) stay as they are. A member's value read
    from this copy tells whether it was a string (S and the string), a scalar
    ("N") or a container (its own text), whatever the lengths involved.
    """
    def mark(t: Column, after: Column) -> Column:
        kind = _kind(t, constants)
        key = F.coalesce(after == ":", F.lit(False))
        return (
            F.when((kind == "s") & ~key, F.concat(F.lit('"S'), F.substring(t, F.lit(2), F.length(t))))
            .when(kind == "v", F.lit('"N"'))
            .otherwise(t)
        )

    following = F.slice(ts, 2, F.greatest(F.size(ts), F.lit(1)))
    return F.array_join(F.zip_with(ts, following, mark), "")


def strict_value(c: Column, constants: bool = True, ts: Column | None = None) -> Column:
    """``struct(members)`` when the whole text is one JSON value (``recognised``), else null.

    ``members`` maps each key of a top-level object to its value as read from
    ``_marked`` (the last of repeated keys wins, as in a Python dict); it is null
    for other values. Nothing is shortened: keys and strings of any length are
    compared whole. An object nested deeper than the reader's 1,000 levels has
    no value (CPython refuses such depth too). ``ts`` may hold ``tokens(c)``.
    """
    ts = tokens(c) if ts is None else ts
    read = F.from_json(_marked(ts, constants), "map<string,string>", _READ)
    # The reader keeps repeated keys; rebuilt, the session's LAST_WIN policy keeps the last.
    read = F.map_from_entries(F.map_entries(read))
    is_object = F.coalesce(F.element_at(ts, 1) == "{", F.lit(False))
    ok = recognised(c, constants, ts) & (~is_object | read.isNotNull())
    return F.when(ok, F.struct(F.when(is_object, read).alias("members")))


def members(value: Column) -> Column:
    """Members of a JSON object (key to marked value); null for any other value."""
    return value["members"]


def type_name(c: Column) -> Column:
    """Python's name for the type of a valid JSON text, told by its first character."""
    head = F.substring(c, 1, 1)
    return (
        F.when(head == "{", "dict")
        .when(head == "[", "list")
        .when(head == '"', "str")
        .when(head.isin("t", "f"), "bool")
        .when(head == "n", "NoneType")
        .when(c.rlike(r"\A-?[0-9]+\z"), "int")
        .otherwise("float")
    )


def absent_keys(required: Column, obj: Column) -> Column:
    """Required keys the object lacks, in their order; empty for other values."""
    return F.filter(
        required, lambda k: F.isnotnull(obj) & ~F.map_contains_key(obj, k)
    )


def member_text(member: Column) -> Column:
    """The string of a member read from the marked copy; null for other values."""
    return F.when(F.startswith(member, F.lit("S")), F.substring(member, F.lit(2), F.length(member)))


def enum_breaches(enums: Column, obj: Column) -> Column:
    """Allowed lists of those string members whose value is not in the list."""

    def breach(key: Column, allowed: Column) -> Column:
        member = F.try_element_at(obj, key)
        text = member_text(member)
        is_text = F.isnotnull(text)
        listed = F.coalesce(F.array_contains(allowed, text), F.lit(False))
        return F.coalesce(is_text & ~listed, F.lit(False))

    return F.map_filter(enums, breach)


# The messages of Python's JSON decoder.
_MESSAGES = {
    _VALUE: "Expecting value",
    _ITEM_OR_CLOSE: "Expecting value",
    _KEY_OR_CLOSE: "Expecting property name enclosed in double quotes",
    _KEY: "Expecting property name enclosed in double quotes",
    _COLON: "Expecting ':' delimiter",
    _AFTER: "Expecting ',' delimiter",
}
_EXTRA = "Extra data"
_TRAILING = {"}": "Illegal trailing comma before end of object", "]": "Illegal trailing comma before end of array"}
_WHITE = "\x20\x09\x0a\x0d"
#: Every token and every run of white space: their concatenation is the text.
_PIECE = rf"[\x20\x09\x0A\x0D]++|{_TOKEN}"
#: The longest start of a string that is still sound.
_SOUND_STRING = r'\A"[^"\\\x00-\x1F]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1F]*+)*+'


def _message(expect: Column, stack: Column) -> Column:
    done = (expect == _AFTER) & (F.length(stack) == 0)
    by_state = F.create_map(*[x for k, v in _MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    return F.when(done, F.lit(_EXTRA)).otherwise(F.element_at(by_state, expect))


def first_error(c: Column, constants: bool = True) -> Column:
    """``struct(message, position)`` of the first fault of a JSON text, as Python's decoder
    reports it (0-based character position); null when the text is one JSON value.

    The automaton of ``recognised`` runs over tokens and runs of white space, so
    it knows where each token starts. A refused token names the decoder's state
    at that place; a text that ends early is at its end. A string refused where
    one may stand is scanned for the decoder's own fault inside it: an
    unterminated string (its quote), a control character, or a bad escape.
    """
    pieces = F.regexp_extract_all(c, F.lit(_PIECE), 0)
    start = F.struct(
        F.lit("").alias("stack"), F.lit(_VALUE).alias("expect"), F.lit(True).alias("ok"),
        F.lit(0).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("bad"),
        F.lit(None).cast("string").alias("message"), F.lit(0).cast("bigint").alias("comma"),
    )

    def step(state: Column, t: Column) -> Column:
        stack, expect, pos, comma = state["stack"], state["expect"], state["pos"], state["comma"]
        kind = _kind(t, constants)
        ahead = pos + F.length(t)

        def moved(to_stack: Column, to_expect: Column) -> Column:
            return F.struct(
                to_stack.alias("stack"), to_expect.alias("expect"), F.lit(True).alias("ok"), ahead.alias("pos"),
                state["bad"].alias("bad"), state["message"].alias("message"),
                F.when(t == ",", pos).otherwise(comma).alias("comma"),
            )

        out = F.when(~state["ok"], state).when(F.substring(t, 1, 1).isin(*_WHITE), moved(stack, expect))
        for when, to_stack, to_expect in _transitions(stack, expect, kind):
            out = out.when(when, moved(to_stack, to_expect))
        # A closer right after a comma: the decoder names the comma (Python 3.13).
        trailing = ((t == "}") & (expect == _KEY)) | ((t == "]") & (expect == _VALUE) & (F.substring(stack, -1, 1) == "["))
        message = F.when(trailing & (t == "}"), F.lit(_TRAILING["}"])).when(trailing, F.lit(_TRAILING["]"])).otherwise(_message(expect, stack))
        # A refused token does not advance pos, so pos is where it starts.
        return out.otherwise(F.struct(
            stack.alias("stack"), expect.alias("expect"), F.lit(False).alias("ok"), pos.alias("pos"),
            t.alias("bad"), message.alias("message"), comma.alias("comma"),
        ))

    def finish(s: Column) -> Column:
        complete = (s["expect"] == _AFTER) & (F.length(s["stack"]) == 0)
        at = F.when(s["message"].isin(*_TRAILING.values()), s["comma"]).otherwise(s["pos"])
        return F.when(
            ~s["ok"], F.struct(s["message"].alias("message"), at.alias("position"), s["bad"].alias("bad"))
        ).when(
            ~complete, F.struct(_message(s["expect"], s["stack"]).alias("message"), s["pos"].alias("position"), F.lit(None).cast("string").alias("bad"))
        )

    fault = F.aggregate(pieces, start, step, finish)
    return F.when(F.isnotnull(c), _inside_string(c, fault))


def _inside_string(c: Column, fault: Column) -> Column:
    at = fault["position"]
    rest = F.substring(c, (at + 1).cast("int"), F.length(c))
    sound = F.length(F.regexp_extract(rest, _SOUND_STRING, 0))
    after = F.substring(rest, sound + 1, 1)
    string_here = (fault["bad"] == '"') & fault["message"].isin(_MESSAGES[_VALUE], _MESSAGES[_KEY])
    escape = F.substring(rest, sound + 2, 1)
    # The decoder wants a character after a \uXXXX escape: one that ends the text is refused at its u.
    last_escape = F.substring(rest, 1, sound).rlike(r"(?<!\\)(?:\\\\)*\\u[0-9a-fA-F]{4}\z")
    message = (
        F.when((after == "") & last_escape, F.lit("Invalid \\uXXXX escape"))
        .when(after == "", F.lit("Unterminated string starting at"))
        .when(after != "\\", F.lit("Invalid control character at"))
        .when(escape == "", F.lit("Unterminated string starting at"))
        .when(escape == "u", F.lit("Invalid \\uXXXX escape"))
        .otherwise(F.lit("Invalid \\escape"))
    )
    position = (
        F.when((after == "") & last_escape, at + sound - 5)
        .when((after == "") | ((after == "\\") & (escape == "")), at)
        .when(after != "\\", at + sound)
        .when(escape == "u", at + sound + 1)
        .otherwise(at + sound)
    )
    return F.when(
        F.isnotnull(fault),
        F.when(string_here, F.struct(message.alias("message"), position.cast("bigint").alias("position")))
        .otherwise(F.struct(fault["message"].alias("message"), fault["position"].alias("position"))),
    )


def line_and_column(c: Column, position: Column) -> Column:
    """``struct(line, column)`` of a 0-based character position, 1-based as Python gives them."""
    before = F.substring(c, 1, position.cast("int"))
    line = F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1
    column = F.length(F.substring_index(before, "\n", -1)) + 1
    return F.struct(line.cast("bigint").alias("line"), column.cast("bigint").alias("column"))
