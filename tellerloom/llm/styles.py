"""What style sheets of a page say about ``display`` and ``visibility`` of its elements.

Selectors are lists of compounds of a tag or ``*``, classes and ids, with descendants and children. Rules
within ``@media`` count if they are for all media or screens without a condition; those of other at-rules,
and selectors with pseudo-classes, attributes or siblings, do not apply. Of several declarations the
important ones win, then those of the ``style`` attribute, then the more specific, then the later.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

PROPERTIES = ("display", "visibility")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
STRING = re.compile(r"\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'", re.S)
DECLARATION = re.compile(
    r"(?:^|;)\s*+(display|visibility)\s*+:\s*+([a-z-]++)[^;!]*+(!\s*+important)?", re.I
)
COMPOUND = re.compile(r"(\*|[A-Za-z][\w-]*+)?((?:[.#][\w-]++)*+)")
# The media that a rule without a condition is for.
SCREENS = frozenset(["", "all", "screen", "only screen", "only all"])

# Of a property: its value, and what it is ranked by.
Declared = dict[str, tuple[tuple, str]]


def is_for_screens(attributes: dict[str, str]) -> bool:
    """Whether a style element holds a sheet in CSS for screens."""
    kind = attributes.get("type", "").strip().lower()
    return kind in ("", "text/css") and _has_screens(attributes.get("media", ""))


def _has_screens(media: str) -> bool:
    return any(" ".join(part.lower().split()) in SCREENS for part in media.split(","))


def declared(text: str, rank: tuple) -> Declared:
    """The declarations of a rule or a style attribute."""
    found: Declared = {}
    for place, (name, value, important) in enumerate(DECLARATION.findall(text)):
        own = ((bool(important), *rank, place), value.lower())
        name = name.lower()
        found[name] = max(found.get(name, own), own)
    return found


def merged(some: Declared, others: Declared) -> Declared:
    """The stronger of both for each property."""
    out = dict(some)
    for name, own in others.items():
        out[name] = max(out.get(name, own), own)
    return out


@dataclass(frozen=True)
class Compound:
    tag: str
    classes: frozenset[str]
    ids: frozenset[str]

    @property
    def key(self) -> str:
        """One thing that an element must have, the rarest kind of those that are asked for."""
        if self.ids:
            return "#" + min(self.ids)
        return "." + min(self.classes) if self.classes else self.tag

    @property
    def specificity(self) -> tuple[int, int, int]:
        return len(self.ids), len(self.classes), int(self.tag != "*")

    def fits(self, name: str, classes: set[str], own_id: str | None) -> bool:
        return (
            self.tag in ("*", name) and self.classes <= classes and self.ids <= {own_id}
        )


def compound(text: str) -> Compound | None:
    found = COMPOUND.fullmatch(text)
    if not found or not text:
        return None
    parts = re.findall(r"([.#])([\w-]+)", found[2])
    return Compound(
        (found[1] or "*").lower(),
        frozenset(name for mark, name in parts if mark == "."),
        frozenset(name for mark, name in parts if mark == "#"),
    )


def selector(text: str) -> tuple[tuple[bool, Compound], ...] | None:
    """Compounds from the outermost to the element, each with whether it is a child of the one before."""
    words = re.sub(r"\s*>\s*", " > ", text).split()
    out, child = [], False
    for i, word in enumerate(words):
        if word == ">":
            if child or not out or i + 1 == len(words):
                return None
            child = True
            continue
        found = compound(word)
        if found is None:
            return None
        out.append((child, found))
        child = False
    return tuple(out) or None


def rules_of(sheet: str) -> list[tuple[str, str]]:
    """Selector lists and declarations of the rules that apply to screens, in order."""
    text = STRING.sub("''", COMMENT.sub(" ", sheet.replace("<!--", " ").replace("-->", " ")))
    found = []
    # For each open brace, what is before it, and whether what is within applies.
    opened: list[tuple[str, bool]] = []
    before = ""
    for token in re.split(r"([{}])", text):
        if token == "{":
            prelude = before.rpartition(";")[2].strip()
            applies = all(ok for _, ok in opened)
            if prelude.startswith("@"):
                name, _, media = prelude.partition(" ")
                applies = applies and name.lower() == "@media" and _has_screens(media)
            opened.append((prelude, applies))
        elif token == "}":
            if opened:
                prelude, applies = opened.pop()
                if applies and not prelude.startswith("@"):
                    found.append((prelude, before))
        before = token
    return found


class Sheet:
    """The rules of all sheets of a page, by what an element must have to fit."""

    def __init__(self, sheets: list[str]):
        # Rules of one compound, what is declared for each merged; the steps of longer selectors.
        self.single: dict[str, dict[Compound, Declared]] = {}
        self.steps: dict[str, list[tuple[int, int, bool, Compound, Declared | None]]] = {}
        order = 0
        for sheet in sheets:
            if not any(name in sheet.lower() for name in PROPERTIES):
                continue
            for selectors, text in rules_of(sheet):
                if not declared(text, ()):
                    continue
                for part in selectors.split(","):
                    order += 1
                    self._add(selector(part.strip()), text, order)

    def _add(
        self, chain: tuple[tuple[bool, Compound], ...] | None, text: str, order: int
    ) -> None:
        if chain is None:
            return
        specificity = tuple(map(sum, zip(*(c.specificity for _, c in chain), strict=True)))
        own = declared(text, (False, specificity, order))
        if len(chain) == 1:
            last = chain[0][1]
            rules = self.single.setdefault(last.key, {})
            rules[last] = merged(rules.get(last, {}), own)
            return
        for i, (child, step) in enumerate(chain):
            at_end = own if i + 1 == len(chain) else None
            self.steps.setdefault(step.key, []).append((order, i, child, step, at_end))

    def __bool__(self) -> bool:
        return bool(self.single or self.steps)


Reached = frozenset[tuple[int, int]]


def apply(root: Any, sheets: list[str]) -> None:
    """Set ``display`` and ``visibility`` of all elements of a tree, from their attributes and the sheets.

    A node has ``name``, ``attributes`` and ``children``, which are nodes or texts.
    """
    sheet = Sheet(sheets)
    none: Reached = frozenset()
    # Nodes with the steps that some element around them, and their parent, have reached.
    nodes: list[tuple[Any, Reached, Reached]] = [(root, none, none)]
    while nodes:
        node, around, parent = nodes.pop()
        attributes = node.attributes
        found: Declared = {}
        if "style" in attributes:
            found = declared(attributes["style"], (True, (), 0))
        own = none
        if sheet:
            reached = []
            classes, own_id = set(attributes.get("class", "").split()), attributes.get("id")
            keys = ["*", node.name, *(f".{name}" for name in classes)]
            if own_id is not None:
                keys.append(f"#{own_id}")
            for key in keys:
                for rule, values in sheet.single.get(key, {}).items():
                    if rule.fits(node.name, classes, own_id):
                        found = merged(found, values)
                for order, i, child, step, values in sheet.steps.get(key, ()):
                    before = (order, i - 1)
                    if i and before not in (parent if child else around):
                        continue
                    if step.fits(node.name, classes, own_id):
                        if values is None:
                            reached.append((order, i))
                        else:
                            found = merged(found, values)
            own = frozenset(reached)
        if found:
            node.display = found["display"][1] if "display" in found else None
            node.visibility = found["visibility"][1] if "visibility" in found else None
        # The same set goes down where an element has reached nothing new.
        inside = around if own <= around else around | own
        nodes += [(c, inside, own) for c in node.children if not isinstance(c, str)]
