"""Quotes against their sources, and the shape of generated roles."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np

from ..functions.legal_zh import fold

LEAST_QUOTE, LEAST_NEEDLE, LEAST_RATIO, ANCHOR = 3, 8, 0.90, 4


def contains_folded(container: str, quote: str) -> bool:
    """Whether a quote is in a text, widths and white space aside."""
    return fold(quote) in fold(container)


_folded_char = lru_cache(maxsize=1 << 16)(fold)


def _folded_with_places(text: str) -> tuple[str, list[int]]:
    """Folded characters, and for each the place in the text it came from."""
    folded = [_folded_char(char) for char in text]
    return "".join(folded), [at for at, chars in enumerate(folded) for _ in chars]


def _candidates(folded: str, needle: str) -> list[tuple[float, int, int]]:
    """(bound, start, size) of the stretches that can be alike enough, the greatest bound first and the earliest of equals.

    The bound is ``SequenceMatcher.quick_ratio``: how many characters both have,
    in any order.  It is taken for all stretches at once from running counts of
    each of the needle's characters, not from every stretch anew.
    """
    places = []
    for offset in range(0, len(needle) - ANCHOR + 1, ANCHOR):
        at = folded.find(needle[offset : offset + ANCHOR])
        while at >= 0:
            places.append(at - offset)
            at = folded.find(needle[offset : offset + ANCHOR], at + 1)
    starts = np.unique(np.unique(np.array(places, dtype=np.int64))[:, None] + np.arange(-3, 4))
    starts = starts[(starts >= 0) & (starts < len(folded))]
    sizes = np.arange(len(needle) - 3, len(needle) + 4)
    ends = starts[:, None] + sizes
    whole = ends <= len(folded)
    codes = np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    shared = np.zeros(ends.shape, dtype=np.int64)
    running = np.zeros(len(codes) + 1, dtype=np.int64)
    for char, n in Counter(needle).items():
        np.cumsum(codes == ord(char), out=running[1:])
        shared += np.minimum(running[np.minimum(ends, len(codes))] - running[starts][:, None], n)
    bounds = 2.0 * shared / (sizes + len(needle))
    rows, columns = np.nonzero(whole & (bounds >= LEAST_RATIO))
    found = zip(bounds[rows, columns].tolist(), starts[rows].tolist(), sizes[columns].tolist())
    return sorted(found, key=lambda x: (-x[0], x[1], x[2]))


def closest_quote(snippet: str, sources: list[str]) -> str | None:
    """The stretch of a source most like a snippet, at least 0.9 alike; None if there is none (V2).

    Stretches are tried where one of the snippet's four-character pieces
    occurs, shifted by up to three; the earliest of equals is taken.
    """
    needle = fold(snippet)
    if len(needle) < LEAST_NEEDLE:
        return None
    matcher = SequenceMatcher(autojunk=False)
    matcher.set_seq2(needle)
    best, found = LEAST_RATIO, None
    for source in sources:
        folded, places = _folded_with_places(source)
        here = None  # the best stretch of this source, by its place
        for bound, start, size in _candidates(folded, needle):
            if bound < best:
                break
            matcher.set_seq1(folded[start : start + size])
            ratio = matcher.ratio()
            if ratio > best or (ratio == best and (here is not None and (start, size) < here or found is None and here is None)):
                best, here = ratio, (start, size)
        if here is not None:
            found = source[places[here[0]] : places[here[0] + here[1] - 1] + 1]
    return found


def repair_snippets(snippets: list[str], sources: list[str]) -> tuple[list[str], list[str]]:
    """Snippets replaced by exact quotes; unverifiable ones go if a good one stays; and what was done (V3)."""
    done, out = [], []
    for snippet in snippets:
        if any(contains_folded(s, snippet) for s in sources):
            out.append((snippet, True))
        elif (quote := closest_quote(snippet, sources)) is not None:
            out.append((quote, True))
            done.append("replaced")
        else:
            out.append((snippet, False))
    if any(good for _, good in out) and not all(good for _, good in out):
        done += ["dropped"] * sum(not good for _, good in out)
        out = [x for x in out if x[1]]
    return [s for s, _ in out], done


def cited_ids(value) -> list[str]:
    """All evidence ids anywhere in a nested value, in order."""
    if isinstance(value, dict):
        own = [i for i in value.get("evidence_ids") or [] if isinstance(i, str) and i]
        return own + [i for k, v in value.items() if k != "evidence_ids" for i in cited_ids(v)]
    if isinstance(value, list):
        return [i for v in value for i in cited_ids(v)]
    return []


#: what a role has to fill in, and where in its brief every entry has to cite evidence
ROLE_BRIEFS = {
    "prosecutor": ("prosecution_brief", ("theory_of_case", "facts_asserted", "evidence_arguments")),
    "defense": ("defense_brief", ("admissions", "disputes", "evidence_arguments")),
    "judge": ("decision", ("issue_findings", "response_to_prosecution", "response_to_defense", "rationale")),
}


def _trace_errors(trace, sources: list[str]):
    if not isinstance(trace, list) or not trace:
        yield "missing_trace"
        return
    for step in trace:
        step = step if isinstance(step, dict) else {}
        if not step.get("evidence_ids"):
            yield "step_without_evidence"
        snippets = step.get("support_snippets")
        if not isinstance(snippets, list) or not snippets:
            yield "step_without_snippet"
            continue
        for snippet in snippets:
            if not isinstance(snippet, str) or len(snippet.strip()) < LEAST_QUOTE:
                yield "invalid_snippet"
            elif not any(contains_folded(s, snippet.strip()) for s in sources):
                yield "snippet_not_in_sources"


def _brief_errors(brief: dict, parts: tuple[str, ...]):
    for part in parts:
        entries = [brief.get(part)] if part == "theory_of_case" else brief.get(part)
        if not isinstance(entries, list):
            yield "brief_part_is_no_list"
        elif any(not isinstance(e, dict) or not e.get("evidence_ids") for e in entries):
            yield "brief_without_evidence"


def role_errors(output: dict, role: str, known_ids: set[str], sources: list[str], holding: str | None = None) -> list[str]:
    """What is wrong with a generated role, each kind once, in the order of the checks; empty if nothing (V1).

    A role names itself, fills in its issues, trace and brief, claims no new
    evidence, quotes what it was shown, cites evidence it was given and cites
    some.  A hypothetical of the defense says that it is not asserted; the
    judge's holding is the given one.
    """
    if not isinstance(output, dict):
        return ["wrong_role"]
    brief_name, parts = ROLE_BRIEFS[role]
    errors = [] if output.get("role") == role else ["wrong_role"]
    errors += [f"missing_{field}" for field in ("issues", brief_name) if not output.get(field)]
    if output.get("new_evidence_claimed") != []:
        errors.append("new_evidence_claimed")
    errors += _trace_errors(output.get("reasoning_trace"), sources)
    brief = output.get(brief_name)
    errors += _brief_errors(brief if isinstance(brief, dict) else {}, parts)
    cited = set(cited_ids(output))
    errors += ["unknown_evidence_id"] * bool(cited - known_ids) + ["no_evidence_cited"] * (not cited)
    guesses = output.get("hypotheticals") or [] if role == "defense" else []
    if any(not isinstance(h, dict) or h.get("is_asserted_fact") is not False for h in guesses):
        errors.append("hypothetical_asserted")
    if role == "judge" and (brief if isinstance(brief, dict) else {}).get("target_holding") != holding:
        errors.append("holding_mismatch")
    return list(dict.fromkeys(errors))


def migrate_legal_rules(trace: list[dict], documents: dict[str, str]) -> list[dict]:
    """Steps that state the law cite documents, not evidence (K4)."""
    out = []
    for step in trace:
        if step.get("claim_type") == "legal_rule":
            named = [n for n, t in documents.items() if any(contains_folded(t, s) for s in step.get("support_snippets") or [])]
            step = {**step, "evidence_ids": [], "legal_sources": named or ["role_context"]}
        out.append(step)
    return out
