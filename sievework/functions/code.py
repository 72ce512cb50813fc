"""Functions on Python code: names, string keys, risks of operations, test values."""

from __future__ import annotations

import ast
import re

import numpy as np

RISKS = {"factorial": "negative_factorial", "gamma": "negative_factorial", "sqrt": "domain_error", "log": "domain_error", "log10": "domain_error", "log2": "domain_error", "arccos": "domain_error", "acosh": "domain_error"}


def function_name(code: str | None) -> str | None:
    """The first function in breadth-first order; None if there is none or the code can't be read."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError):
        return None
    return next((n.name for n in ast.walk(tree) if isinstance(n, ast.FunctionDef)), None)


def names_in(node: ast.AST) -> set[str]:
    return {n.id for n in ast.walk(node) if isinstance(n, ast.Name)}


def unsafe_operations(code: str | None, args: list[str]) -> dict[str, list[str]]:
    """argument -> risks: dividing by it, factorials, roots and logarithms of it; empty lists for code that can't be read."""
    out: dict[str, list[str]] = {a: [] for a in args}
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError):
        return out

    def note(node: ast.AST, risk: str) -> None:
        for name in sorted(names_in(node) & set(args)):
            if risk not in out[name]:
                out[name].append(risk)

    for node in ast.walk(tree):
        formats = isinstance(node, ast.BinOp) and isinstance(node.left, (ast.Constant, ast.JoinedStr)) and not isinstance(getattr(node.left, "value", ""), (int, float, complex))
        if isinstance(node, ast.BinOp) and isinstance(node.op, (ast.Div, ast.FloorDiv, ast.Mod)) and not formats:
            note(node.right, "division_by_zero")
        elif isinstance(node, ast.Call):
            called = node.func.attr if isinstance(node.func, ast.Attribute) else getattr(node.func, "id", "")
            for argument in node.args if called in RISKS else ():
                note(argument, RISKS[called])
    return out


def string_keys(code: str | None, arg: str) -> list[str]:
    """Strings an argument is compared with, or looked up by in literal dictionaries, each once, in order."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError):
        return []
    dicts = {t.id: n.value for n in ast.walk(tree) if isinstance(n, ast.Assign) and isinstance(n.value, ast.Dict) for t in n.targets if isinstance(t, ast.Name)}
    found: list[str] = []

    def put(values: list[ast.expr | None]) -> None:
        found.extend(v.value for v in values if isinstance(v, ast.Constant) and isinstance(v.value, str) and v.value not in found)

    for node in ast.walk(tree):
        if isinstance(node, ast.Compare) and isinstance(node.left, ast.Name) and node.left.id == arg:
            for right in node.comparators:
                put(right.elts if isinstance(right, (ast.Tuple, ast.List, ast.Set)) else [right])
        looked = None
        if isinstance(node, ast.Subscript) and isinstance(node.slice, ast.Name) and node.slice.id == arg:
            looked = node.value
        elif isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr == "get" and node.args and isinstance(node.args[0], ast.Name) and node.args[0].id == arg:
            looked = node.func.value
        if isinstance(looked, ast.Name):
            looked = dicts.get(looked.id)
        if isinstance(looked, ast.Dict):
            put(looked.keys)
    return found


def documented_values(doc: str | None, arg: str) -> list[str] | None:
    """Values a docstring lists for an argument ("one of 'a', 'b'", "'a' or 'b'"), None if it lists none."""
    text, quoted = doc or "", r"['\"]([^'\"\n]+)['\"]"
    run = rf"\{{?\s*{quoted}(?:\s*(?:,|or|,\s*or)\s*{quoted})*"
    places = [rf"\b{re.escape(arg)}\b[^.]*?(?:one of|either|must be|values?:|:)\s*({run})", rf"\b(?:can be |must be )?one of:?\s*({run})"]
    for place in places:
        found = re.search(place, text, re.IGNORECASE)
        if found:
            return list(dict.fromkeys(re.findall(quoted, found.group(1))))
    return None


def arguments(code: str | None) -> list[str]:
    """Names of the first function's arguments, [] where there is none."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError):
        return []
    head = next((n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef)), None)
    return [a.arg for a in head.args.args] if head else []


def argument_types(code: str | None) -> dict[str, str]:
    """argument -> the name of its type, for annotated arguments of the first function; Optional[T] is T."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError):
        return {}
    head = next((n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef)), None)
    found = {a.arg: ast.unparse(a.annotation) for a in head.args.args if a.annotation} if head else {}
    return {name: re.sub(r"^Optional\[(.*)\]$", r"\1", kind).split("[")[0].split(".")[-1] for name, kind in found.items()}


def coerced(value: object, kind: str) -> object:
    """A value as the named type; as it is where that fails. Truth is only what says so."""
    try:
        if kind == "bool":
            return value if isinstance(value, bool) else str(value).strip().lower() in ("true", "1", "yes")
        if kind == "int":
            return int(float(str(value)))
        if kind == "float":
            return float(str(value))
        if kind == "complex":
            if isinstance(value, (list, tuple)):
                return complex(*map(float, value))
            if isinstance(value, dict):
                return complex(float(value["re"]), float(value["im"]))
            return complex(str(value).strip("() ").replace("i", "j"))
        if kind in ("tuple", "Tuple"):
            return tuple(value)  # type: ignore[arg-type]
        if kind in ("ndarray", "array"):
            return np.array(value, dtype=float)
    except (TypeError, ValueError, KeyError):
        pass
    return value


def rehydrated(value: object) -> object:
    """Values back from ``jsonable`` and from other JSON forms: "(1+2j)" and {"re", "im"} as complex numbers, at every depth."""
    if isinstance(value, dict):
        if set(value) == {"re", "im"} and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in value.values()):
            return complex(value["re"], value["im"])
        return {k: rehydrated(v) for k, v in value.items()}
    if isinstance(value, list):
        return [rehydrated(v) for v in value]
    if isinstance(value, str) and re.fullmatch(r"\(?[-+]?[\d.]+(?:e[-+]?\d+)?(?:[-+][\d.]+(?:e[-+]?\d+)?)?[ij]\)?", value):
        return complex(value.strip("()").replace("i", "j"))
    return value


def jsonable(value: object) -> object:
    """Plain JSON of results: complex numbers as text, tuples and arrays as lists, numpy scalars as numbers."""
    if isinstance(value, (complex, np.complexfloating)):
        return str(complex(value))
    if isinstance(value, np.ndarray):
        return jsonable(value.tolist())
    if isinstance(value, np.generic):
        return jsonable(value.item())
    if isinstance(value, (list, tuple)):
        return [jsonable(v) for v in value]
    if isinstance(value, dict):
        return {str(k): jsonable(v) for k, v in value.items()}
    if value is None or isinstance(value, (str, bool, int)):
        return value
    if isinstance(value, float):
        return value if np.isfinite(value) else None
    return str(value)


def test_value(kind: str, draw: np.random.Generator, choices: list[str] | None = None, size: int | None = None) -> object:
    """A value of a type by rule; null for types that are not known."""
    if choices:
        return choices[int(draw.integers(len(choices)))]
    if kind == "float":
        return round(float(draw.uniform(0.1, 10)), 3)
    if kind == "int":
        return int(draw.integers(-10, 10))
    if kind == "bool":
        return bool(draw.integers(2))
    if kind == "str":
        return "".join(chr(97 + int(c)) for c in draw.integers(0, 26, int(draw.integers(3, 8))))
    if kind == "complex":
        a, b = draw.uniform(-10, 10, 2)
        return str(complex(round(float(a), 3), round(float(b), 3)))
    if kind in ("tuple", "Tuple", "list", "List", "ndarray", "array"):
        return [round(float(x), 3) for x in draw.uniform(0.1, 10, size or int(draw.integers(2, 6)))]
    return None
