"""Chat formatting in budgeted windows. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: A token is a run of letters and digits or any other visible character; the marks of a turn count as 4.
_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
_TURN_TOKENS = 4


def escape(text: Column) -> Column:
    """Text in which no control string can begin: a backslash is doubled, ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    """Escaped, and on one line: a line feed becomes ``\\n`` (a lone backslash and an n)."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def conversation_windows(
    conversations: DataFrame, budget: int = 1024, history_turns: int = 2, history_tokens: int = 256
) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``windows``, an array of
    ``(text, n_repeated, n_tokens, loss)`` with ``loss`` an array of ``(start, length)``.

    Prefix sums of the turns' tokens choose the windows: a window takes whole turns
    as long as the system turn, the repeated history and they fit into ``budget``
    tokens. Every window begins with the system turn if there is one, then repeats
    the turns just before it, at most ``history_turns`` of them and
    ``history_tokens`` tokens; ``n_repeated`` turns in front are repeats. ``loss``
    marks, in code points of ``text``, the texts of assistant turns that are not
    repeats, so each target is learnt once. A turn that alone exceeds the budget
    gets a window of its own; nothing is cut.

    Turns are ordered by ``turn`` (null first), then role and text, so ties have a
    defined order; a repeated row is a turn of its own. Null text or role: empty.
    Rows without ``conv_id`` form one conversation. Other columns are not used. A
    conversation is one sample and is held as one row, like a document.
    """
    turns = (
        conversations.select(
            "conv_id",
            F.struct(
                "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
    )
    header = "length(x.role) + 13"
    prepared = (
        turns.select(
            "conv_id",
            F.transform(
                "t",
                lambda x: F.struct(
                    _escape_role(x.role).alias("role"),
                    escape(x.text).alias("text"),
                    (F.regexp_count(x.text, F.lit(_TOKEN)) + _TURN_TOKENS).cast("long").alias("tok"),
                    (x.role == "assistant").alias("target"),
                ),
            ).alias("t"),
        )
        .withColumn("b", F.expr("if(t[0].role = 'system', 1, 0)"))
        .withColumn("n", F.size("t"))
        .withColumn("pieces", F.expr(f"transform(t, x -> concat('{OPEN}', x.role, '\\n', x.text, '{CLOSE}', '\\n'))"))
        # Prefix sums over the turns: tokens and code points before each.
        .withColumn("p", F.expr("aggregate(t, array(0L), (a, x) -> array_append(a, element_at(a, -1) + x.tok))"))
        .withColumn(
            "q", F.expr("aggregate(pieces, array(0L), (a, x) -> array_append(a, element_at(a, -1) + length(x)))")
        )
        # First repeated turn of a window that begins at each turn.
        .withColumn(
            "back",
            F.expr(
                f"""transform(sequence(0, n - 1), i -> if(i < b, i, array_min(filter(
                    sequence(greatest(b, i - {history_turns}), i), j -> p[i] - p[j] <= {history_tokens}L))))"""
            ),
        )
        .withColumn(
            "starts",
            F.expr(
                f"""if(n = b, array(b), aggregate(sequence(b, n - 1), array(b), (a, i) ->
                    if(i = element_at(a, -1) OR p[b] + p[i + 1] - p[back[element_at(a, -1)]] <= {budget}L,
                       a, array_append(a, i))))"""
            ),
        )
    )
    return prepared.select(
        "conv_id",
        F.expr(
            f"""transform(starts, (s, k) -> transform(array(named_struct(
                's', s, 'h', if(s < n, back[s], s), 'e', coalesce(get(starts, k + 1), n))), w -> named_struct(
                'text', array_join(concat(slice(pieces, 1, b), slice(pieces, w.h + 1, w.e - w.h)), ''),
                'n_repeated', cast(w.s - w.h + if(k > 0, b, 0) as long),
                'n_tokens', p[b] + p[w.e] - p[w.h],
                'loss', transform(filter(sequence(w.s, w.e), i -> i < w.e AND t[i].target), i -> named_struct(
                    'start', q[b] + q[i] - q[w.h] + {header.replace("x.", "t[i].")},
                    'length', cast(length(t[i].text) as long)))))[0])"""
        ).alias("windows"),
    )


def chat_windows(conversations: DataFrame, **parameters: int) -> DataFrame:
    """One row per window: ``conv_id, window, text, n_repeated, n_tokens, loss``; see
    :func:`conversation_windows`."""
    rows = conversation_windows(conversations, **parameters)
    return rows.select("conv_id", F.posexplode("windows").alias("window", "w")).select("conv_id", "window", "w.*")


def read_back(windows: Column) -> tuple[Column, Column]:
    """The turns ``(role, text)`` and the texts under the loss mask, both from the
    formatted text alone; repeated turns are left out."""
    turns = F.flatten(
        F.transform(
            windows,
            lambda w: F.transform(
                F.filter(F.slice(F.split(w.text, r"<\|im_start\|>"), w.n_repeated.cast("int") + 2, 2**30), F.isnotnull),
                lambda piece: F.struct(
                    _unescape_role(F.substring_index(piece, "\n", 1)).alias("role"),
                    unescape(
                        F.regexp_extract(piece, r"(?s)^[^\n]*\n(.*)<\|im_end\|>\n$", 1)
                    ).alias("text"),
                ),
            ),
        )
    )
    learnt = F.flatten(
        F.transform(
            windows,
            lambda w: F.transform(
                w.loss, lambda x: unescape(w.text.substr((x.start + 1).cast("int"), x.length.cast("int")))
            ),
        )
    )
    return turns, learnt
