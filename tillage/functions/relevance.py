"""Term matching and explainable keyword relevance, as Column expressions without UDFs."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from tillage.functions.text import filled, normalize

#: What each kind of match is worth (first match, more for each further one, most of those).
CROP = 3
SCENARIO = (4, 3)
ACTION = (2, 2)
EFFECT = (1, 2)
FOCUSED = 2
NOISE_MOST = 3
REASONS = {
    "crop": "matched crop identity",
    "no_crop": "missing crop identity",
    "scenario": "matched weather scenario terms",
    "no_scenario": "missing weather scenario terms",
    "action": "matched action/effect terms",
    "effect": "matched agronomic effect terms",
    "focused": "weather scenario appears in title or subject",
    "noise": "contains crop-only noise terms",
}
DIRECT, SUPPORTING, REJECTED = "direct_match", "supporting_match", "rejected_irrelevant"


def match_form(c: Column) -> Column:
    """Hyphens, underscores and slashes as spaces, then the normal form."""
    return normalize(F.regexp_replace(c, "[-_/]+", " "))


def folded_term(term: str) -> str:
    """A term's match form."""
    return " ".join(re.sub("[-_/]+", " ", term).casefold().split())


def _trie(words: Iterable[str]) -> dict:
    """Nested by characters; the empty key marks the end of a word."""
    root: dict = {}
    for word in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}
    return root


def _regex(node: dict) -> str:
    """The longest word of a trie that matches here; shorter ones are tried after longer ones."""
    literal = lambda c: "\\" + c if c.isascii() and not c.isalnum() else c
    branches = []
    for c in sorted(k for k in node if k):
        path, child = literal(c), node[c]
        while len(child) == 1 and "" not in child:
            (c, child), = child.items()
            path += literal(c)
        branches.append(path + _regex(child))
    if not branches:
        return ""
    inside = branches[0] if len(branches) == 1 and "" not in node else f"(?:{'|'.join(branches)})"
    return inside + ("?" if "" in node else "")


def _alone(text: str, at: int) -> bool:
    """No ASCII letter or digit at a place."""
    return at >= len(text) or not (text[at].isascii() and text[at].isalnum())


def pattern(terms: Iterable[str]) -> str:
    """Java regex that finds, wherever a term (in match form) may begin, the longest one that has no ASCII letter or digit next to it.

    It takes no characters, so terms may overlap, and it walks a trie, so a text is read once whatever the number of terms.
    """
    return f"(?<![a-z0-9])(?=({_regex(_trie(terms))})(?![a-z0-9]))"


def ordered(terms: Column) -> Column:
    """Distinct terms, longest first, ties by the larger string first."""
    keyed = F.transform(F.array_distinct(terms), lambda t: F.struct(F.length(t).alias("n"), t.alias("t")))
    return F.transform(F.sort_array(keyed, asc=False), lambda x: x["t"])


def _table(pairs: dict[str, list[str]]) -> Column:
    return F.from_json(F.lit(json.dumps(pairs, ensure_ascii=False)), "map<string,array<string>>")


def term_hits(form: Column, terms: Iterable[str]) -> Column:
    """The match forms of all terms that occur in a text in match form: one pass of the text for the whole vocabulary.

    Where a term begins only the longest is found by the pattern; the terms that are its beginnings occur too, and are looked up.
    """
    forms = sorted({f for f in map(folded_term, terms) if f})
    if not forms:
        return F.array().cast("array<string>")
    found = F.array_distinct(F.regexp_extract_all(form, F.lit(pattern(forms)), 1))
    known = set(forms)
    nested = {f: [f, *inside] for f in forms if (inside := [f[:n] for n in range(1, len(f)) if f[:n] in known and _alone(f, n)])}
    if not nested:
        return found
    # One reference to what was found, so that the text is searched once.
    return F.array_distinct(F.flatten(F.transform(found, lambda f: F.coalesce(_table(nested)[f], F.array(f)))))


def picked(hits: Column, terms: Sequence[str]) -> Column:
    """Those of some fixed terms whose match forms are among the hits."""
    forms: dict[str, list[str]] = {}
    for t in dict.fromkeys(terms):
        if f := folded_term(t):
            forms.setdefault(f, []).append(t)
    if not forms:
        return F.array().cast("array<string>")
    return ordered(F.flatten(F.filter(F.transform(hits, lambda f: _table(forms)[f]), lambda x: x.isNotNull())))


def picked_of(hits: Column, terms: Column, forms: Column) -> Column:
    """Those of a row's own terms whose match forms, in the same order, are among the hits."""
    some = F.filter(F.arrays_zip(terms.alias("term"), forms.alias("form")), lambda x: F.array_contains(hits, x["form"]))
    return ordered(F.coalesce(F.transform(some, lambda x: x["term"]), F.array().cast("array<string>")))


def matched_terms(form: Column, terms: Sequence[str]) -> Column:
    """The terms that occur in a text in match form; a fixed vocabulary."""
    return picked(term_hits(form, terms), terms)


def metadata_form(title: Column, snippet: Column, abstract: Column, subjects: Column) -> Column:
    return match_form(filled(title, snippet, abstract, F.array_join(subjects, " ")))


def focused_form(title: Column, snippet: Column, subjects: Column) -> Column:
    """All but the abstract."""
    return match_form(filled(title, snippet, F.array_join(subjects, " ")))


def _worth(n: Column, first: int, more: int) -> Column:
    return F.when(n > 0, first + F.least(n - 1, F.lit(more))).otherwise(0)


def assess(crop: Column, scenario: Column, action: Column, effect: Column, focused: Column, noise: Column) -> Column:
    """Struct (status, score, reasons) from six arrays of matched terms.

    Without a crop match a hit is rejected; without a scenario match it supports if an action or an
    effect matched; noise rejects unless the scenario is in the focused text or an action
    matched. A rejected hit scores 0 at most. Reasons come in a fixed order.
    """
    n = {k: F.size(v) for k, v in (("c", crop), ("s", scenario), ("a", action), ("e", effect), ("f", focused), ("n", noise))}
    raw = F.when(n["c"] > 0, CROP).otherwise(0) + _worth(n["s"], *SCENARIO) + _worth(n["a"], *ACTION) + _worth(n["e"], *EFFECT)
    raw = raw + F.when(n["f"] > 0, FOCUSED).otherwise(0) - F.least(n["n"], F.lit(NOISE_MOST))
    other = (n["a"] > 0) | (n["e"] > 0)
    status = (
        F.when(n["c"] == 0, REJECTED)
        .when((n["s"] == 0) & other, SUPPORTING)
        .when(n["s"] == 0, REJECTED)
        .when((n["n"] > 0) & (n["f"] == 0) & (n["a"] == 0), REJECTED)
        .otherwise(DIRECT)
    )
    reasons = F.array(
        F.when(n["c"] > 0, REASONS["crop"]).otherwise(REASONS["no_crop"]),
        F.when(n["s"] > 0, REASONS["scenario"]).otherwise(REASONS["no_scenario"]),
        F.when(n["a"] > 0, REASONS["action"]),
        F.when(n["e"] > 0, REASONS["effect"]),
        F.when(n["f"] > 0, REASONS["focused"]),
        F.when(n["n"] > 0, REASONS["noise"]),
    )
    score = F.when(status == REJECTED, F.least(raw, F.lit(0))).otherwise(raw).cast("int")
    return F.struct(status.alias("status"), score.alias("score"), F.filter(reasons, lambda x: x.isNotNull()).alias("reasons"))


def assess_fields(fields: dict[str, Column], crop: Sequence[str], scenario: Sequence[str], action: Sequence[str], effect: Sequence[str], noise: Sequence[str]) -> dict[str, Column]:
    """Matched terms and the assessment of one query's vocabularies over title, snippet, abstract and subjects."""
    everywhere = term_hits(metadata_form(fields["title"], fields["snippet"], fields["abstract"], fields["subjects"]), [*crop, *scenario, *action, *effect, *noise])
    focus = term_hits(focused_form(fields["title"], fields["snippet"], fields["subjects"]), scenario)
    found = {"matched_crop_terms": picked(everywhere, crop), "matched_scenario_terms": picked(everywhere, scenario), "matched_action_terms": picked(everywhere, action)}
    return found | {"relevance": assess(*found.values(), picked(everywhere, effect), picked(focus, scenario), picked(everywhere, noise))}
