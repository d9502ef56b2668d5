"""What kind of statement a SQL text is, as a column expression.

One pass over the text's marks and words keeps what no regular expression can count: how deep
bracketed comments nest, and which quote, dollar tag or comment the text is in. Words outside of
those tell the kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An escaped quote, a raw literal's beginning, a word, a dollar tag, a hint's beginning, white
# space with line ends apart, or any other character. Comment marks are left as characters: which
# two belong together depends on what came before.
TOKEN = r"""(?is)\\['"`\\\n]|r['"]|[0-9a-z_]+|\$[a-z_]*\$|/\*\+|\n|[^\S\n]+|."""

HEADS = ("select", "with", "values", "from", "table", "map", "reduce")

#: Words that make a statement write, and what follows them.
WRITES = {"insert": ("into", "overwrite"), "delete": ("from",), "merge": ("into",)}


def _step(state: Column, token: Column) -> Column:
    inside, depth, last = state["inside"], state["depth"], state["last"]
    head, before, writes = state["head"], state["before"], state["writes"]

    def to(inside=inside, depth=depth, last=F.lit(""), head=head, before=before, writes=writes) -> Column:
        fields = {"inside": inside, "depth": depth, "last": last, "head": head, "before": before, "writes": writes}
        return F.struct(*[value.alias(name) for name, value in fields.items()])

    code = F.lit("")
    closes = F.when(inside.startswith("r"), token.endswith(F.substring(inside, 2, 1))).otherwise(token == inside)
    comment = (
        F.when((last == "*") & token.startswith("/"), to(depth=depth - 1, inside=F.when(depth == 1, code).otherwise(inside)))
        .when((last == "/") & (token == "*"), to(depth=depth + 1))
        .otherwise(to(last=token))
    )
    space = token.rlike(r"^\s")
    word = token.rlike("^[0-9a-z_]")
    wrote = F.lit(False)
    for first, then in WRITES.items():
        wrote = wrote | ((before == first) & token.isin(*then))
    wrote = wrote | ((before == "update x ") & (token == "set"))
    first = F.coalesce(head, F.when(word, token).otherwise(""))
    # A name behind ``update``, of any tokens up to white space, keeps the word in mind.
    target = F.when((before == "update ") | (before == "update x"), F.lit("update x"))
    opens = token.isin("'", '"', "`", "r'", 'r"') | token.rlike(r"^\$[a-z_]*\$$")
    plain = (
        F.when((last == "/") & (token == "*"), to(inside=F.lit("/*"), depth=F.lit(1)))
        .when(token == "/*+", to(inside=F.lit("/*"), depth=F.lit(1)))
        .when((last == "-") & (token == "-"), to(inside=F.lit("--")))
        .when(token.isin("/", "-"), to(last=token))
        .when(space, to(before=F.when(before.isin("update", "update x"), F.concat(before, F.lit(" "))).otherwise(before)))
        .when(opens, to(inside=token, head=first, before=F.coalesce(target, F.lit(""))))
        .when(word, to(head=first, before=F.coalesce(target, token), writes=writes | wrote))
        .when(token == "(", to(before=F.lit("")))
        .otherwise(to(head=first, before=F.coalesce(target, F.lit(""))))
    )
    return (
        F.when(inside == "", plain)
        .when(inside == "/*", comment)
        .when(inside == "--", to(inside=F.when(token == "\n", code).otherwise(inside)))
        .otherwise(to(inside=F.when(closes, code).otherwise(inside)))
    )


def is_result_query(sql: Column) -> Column:
    """True for statements whose rows are a query result.

    Commands and statements that write (also behind a ``with`` or ``from``) are
    false. Comments nest; a null text has no kind.
    """
    tokens = F.regexp_extract_all(F.lower(sql), F.lit(TOKEN), F.lit(0))
    none = F.lit(None).cast("string")
    start = F.struct(
        F.lit("").alias("inside"), F.lit(0).alias("depth"), F.lit("").alias("last"),
        none.alias("head"), F.lit("").alias("before"), F.lit(False).alias("writes"),
    )
    return F.aggregate(tokens, start, _step, lambda s: F.coalesce(s["head"].isin(*HEADS), F.lit(False)) & ~s["writes"])
