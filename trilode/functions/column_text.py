"""Column expressions in Python notation, as config files hold them, turned into Spark SQL text.

The text is parsed, never evaluated, and only what is listed here is known. Casts and date
functions give NULL where a value does not fit, and a division by zero gives NULL.
"""

from __future__ import annotations

import ast

# The functions and methods such texts use.
AGGREGATES = ("sum", "avg", "mean", "count", "min", "max", "countDistinct", "count_distinct")
SPREADS = ("stddev", "stddev_pop", "stddev_samp", "variance", "var_pop", "var_samp")
NOW = {"current_date": "current_date()", "current_timestamp": "current_timestamp()"}
STARTS = ("col", "lit", "when", "to_date", "to_timestamp", *AGGREGATES, *SPREADS, *NOW)
COMPARISONS = {ast.Eq: "=", ast.NotEq: "<>", ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">="}
# Name in Spark SQL with the least and the most arguments.
SCALARS = {
    "abs": (1, 1), "ceil": (1, 1), "coalesce": (1, 99), "concat": (1, 99), "datediff": (2, 2),
    "dayofmonth": (1, 1), "floor": (1, 1), "greatest": (2, 99), "hour": (1, 1), "initcap": (1, 1),
    "least": (2, 99), "length": (1, 1), "lower": (1, 1), "ltrim": (1, 1), "month": (1, 1),
    "round": (1, 2), "rtrim": (1, 1), "sqrt": (1, 1), "trim": (1, 1), "upper": (1, 1),
    "year": (1, 1),
}
# A whole number is read from text with a fraction as well: '12.5' is 12.
WHOLE = {"byte": "tinyint", "tinyint": "tinyint", "short": "smallint", "smallint": "smallint",
         "int": "int", "integer": "int"}
LONG = ("long", "bigint")
OPERATORS = {ast.BitAnd: "AND", ast.BitOr: "OR", ast.Add: "+", ast.Sub: "-", ast.Mult: "*"}


def _call_name(node: ast.AST) -> str | None:
    """``f`` of ``f(...)`` and ``F.f(...)``."""
    if not isinstance(node, ast.Call):
        return None
    if isinstance(node.func, ast.Name):
        return node.func.id
    if isinstance(node.func, ast.Attribute) and isinstance(node.func.value, ast.Name):
        return node.func.attr if node.func.value.id == "F" else None
    return None


def is_column_text(text: str) -> bool:
    """True if the text is in Python notation: it names a column or a value by a call, or a function
    is given a column as a quoted name. Anything else is left to Spark SQL."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except SyntaxError:
        return False
    for node in ast.walk(tree):
        name = _call_name(node)
        if name in ("col", "lit", "when"):
            return True
        if name in STARTS and node.args and isinstance(node.args[0], ast.Constant) and isinstance(
                node.args[0].value, str):
            return True
    return False


def to_sql(text: str) -> str:
    """Spark SQL for a text in Python notation; ``ValueError`` for anything not listed."""
    try:
        return _Sql(text).of(ast.parse(text.strip(), mode="eval").body)
    except SyntaxError as broken:
        raise ValueError(f"not a column expression: {text!r}") from broken


def as_sql(text: str) -> str:
    """Either notation as Spark SQL."""
    return to_sql(text) if isinstance(text, str) and is_column_text(text) else text


class _Sql:
    def __init__(self, text: str):
        self.text = text

    def unknown(self) -> ValueError:
        return ValueError(f"not a known column expression: {self.text!r}")

    def literal(self, value) -> str:
        if value is None or isinstance(value, bool):
            return {None: "NULL", True: "true", False: "false"}[value]
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(value, (int, float)):
            return repr(value)
        raise self.unknown()

    def constant(self, node: ast.AST):
        try:
            return ast.literal_eval(node)
        except ValueError:
            raise self.unknown() from None

    def name(self, text: str) -> str:
        return ".".join(f"`{part.replace('`', '``')}`" for part in text.split("."))

    def column(self, node: ast.AST) -> str:
        """A function's argument: a quoted name is a column there."""
        if isinstance(node, ast.Constant) and isinstance(node.value, str):
            return self.name(node.value)
        return self.of(node)

    def of(self, node: ast.AST) -> str:
        if isinstance(node, ast.Constant):
            return self.literal(node.value)
        if isinstance(node, ast.UnaryOp):
            if isinstance(node.op, ast.Invert):
                return f"(NOT {self.of(node.operand)})"
            if isinstance(node.op, ast.USub):
                return f"(- {self.of(node.operand)})"
        if isinstance(node, ast.BinOp):
            left, right = self.of(node.left), self.of(node.right)
            if isinstance(node.op, ast.Div):
                return f"try_divide({left}, {right})"
            if type(node.op) in OPERATORS:
                return f"({left} {OPERATORS[type(node.op)]} {right})"
        if isinstance(node, ast.Compare) and len(node.ops) == 1 and type(node.ops[0]) in COMPARISONS:
            sign = COMPARISONS[type(node.ops[0])]
            return f"({self.of(node.left)} {sign} {self.of(node.comparators[0])})"
        if isinstance(node, ast.Call) and not node.keywords:
            name = _call_name(node)
            if name:
                return self.function(name, node.args)
            if isinstance(node.func, ast.Attribute):
                return self.method(node.func.value, node.func.attr, node.args)
        raise self.unknown()

    def function(self, name: str, args: list[ast.AST]) -> str:
        if name in NOW and not args:
            return NOW[name]
        if name == "col" and len(args) == 1:
            return self.name(str(self.constant(args[0])))
        if name == "lit" and len(args) == 1:
            return self.literal(self.constant(args[0]))
        if name == "when" and len(args) == 2:
            return f"CASE {self.branch(args)} END"
        if name in AGGREGATES and len(args) == 1:
            if name == "count" and isinstance(args[0], ast.Constant) and args[0].value in ("*", 1):
                return "count(*)"
            if name in ("countDistinct", "count_distinct"):
                return f"count(DISTINCT {self.column(args[0])})"
            return f"{name}({self.column(args[0])})"
        if name in SPREADS and len(args) == 1:
            return f"{name}({self.column(args[0])})"
        if name in SCALARS and SCALARS[name][0] <= len(args) <= SCALARS[name][1]:
            given = [self.of(a) if name == "round" and i else self.column(a)
                     for i, a in enumerate(args)]
            return f"{name}({', '.join(given)})"
        if name in ("to_date", "to_timestamp") and len(args) in (1, 2):
            kind = name.removeprefix("to_")
            if len(args) == 1:
                return f"try_cast({self.column(args[0])} AS {kind})"
            parsed = f"try_to_timestamp({self.column(args[0])}, {self.of(args[1])})"
            return parsed if kind == "timestamp" else f"CAST({parsed} AS date)"
        raise self.unknown()

    def branch(self, args: list[ast.AST]) -> str:
        return f"WHEN {self.of(args[0])} THEN {self.of(args[1])}"

    def method(self, target: ast.AST, name: str, args: list[ast.AST]) -> str:
        if name in ("when", "otherwise"):
            before = self.of(target)
            if not before.startswith("CASE ") or not before.endswith(" END"):
                raise self.unknown()
            if name == "when" and len(args) == 2:
                return f"{before[:-4]} {self.branch(args)} END"
            if name == "otherwise" and len(args) == 1:
                return f"{before[:-4]} ELSE {self.of(args[0])} END"
            raise self.unknown()
        value = self.of(target)
        if name == "alias":
            return value
        if name == "isin":
            given = [self.constant(a) for a in args]
            items = given[0] if len(given) == 1 and isinstance(given[0], (list, tuple)) else given
            return f"({value} IN ({', '.join(map(self.literal, items))}))"
        if name == "between" and len(args) == 2:
            return f"({value} BETWEEN {self.of(args[0])} AND {self.of(args[1])})"
        if name == "rlike" and len(args) == 1:
            return f"({value} RLIKE {self.of(args[0])})"
        if name == "cast" and len(args) == 1:
            kind = str(self.constant(args[0]))
            if not kind.replace("(", "").replace(")", "").replace(",", "").replace(" ", "").isalnum():
                raise self.unknown()
            if kind.lower() in WHOLE:
                return f"try_cast(try_cast({value} AS double) AS {WHOLE[kind.lower()]})"
            if kind.lower() in LONG:  # a double is exact only to 2^53
                return f"try_cast(try_cast({value} AS decimal(38,6)) AS bigint)"
            return f"try_cast({value} AS {kind})"
        if name in ("startswith", "endswith", "contains", "like") and len(args) == 1:
            given = self.of(args[0])
            return f"({value} LIKE {given})" if name == "like" else f"{name}({value}, {given})"
        if name == "substr" and len(args) == 2:
            return f"substr({value}, {self.of(args[0])}, {self.of(args[1])})"
        if name in ("isNull", "isNotNull") and not args:
            return f"({value} IS {'NOT ' * (name == 'isNotNull')}NULL)"
        raise self.unknown()
