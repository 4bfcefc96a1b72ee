"""Scores, verdicts and enumerations of the story engine as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import Config
from .text import is_non_article
from .times import days_apart, hours_apart, micros

# Fixed values.
SIDES = {"LEFT": "left", "LEAN_LEFT": "left", "CENTER": "center", "LEAN_RIGHT": "right", "RIGHT": "right"}
CREATING_TYPES = ("news", "live", "explainer")
HIDDEN_TYPES = ("roundup",)
OPPOSED = (("supports", "opposes"), ("opposes", "supports"), ("critical_of_left", "critical_of_right"), ("critical_of_right", "critical_of_left"))
CATEGORIES = (
    "politics", "world", "economy", "business", "technology", "health", "science", "climate",
    "crime", "courts", "immigration", "education", "culture", "sports", "other",
)
ARTICLE_TYPES = ("news", "analysis", "opinion", "roundup", "live", "explainer", "other")
DIRECTIONS = ("supports", "opposes", "critical_of_left", "critical_of_right", "neutral", "mixed")
LEANINGS = ("LEFT", "CENTER", "RIGHT")


def clamp01(value: Column) -> Column:
    """A number within 0 and 1; what is no number is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.try_cast("double"), F.lit(0.0))))


def one_of(value: Column, allowed: tuple[str, ...], other: str | None) -> Column:
    return F.when(value.isin(*allowed), value).otherwise(F.lit(other))


def _lower_set(names: Column) -> Column:
    return F.array_distinct(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.lower(x)))


def entity_jaccard(a: Column, b: Column) -> Column:
    """Shared over all names, ignoring case; 0 if either list is empty."""
    x, y = _lower_set(a), _lower_set(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def clean_entities(names: Column, outlet: Column, most: int = 8) -> Column:
    """Names with single spaces, two characters at least, without the own outlet's, each once whatever its case, first spelling."""
    own = F.lower(F.trim(F.coalesce(outlet, F.lit(""))))
    tidy = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    kept = F.filter(tidy, lambda x: (F.length(x) >= 2) & ((own == "") | ~F.contains(F.lower(x), own)))
    lowered = F.transform(kept, lambda x: F.lower(x))
    first = F.filter(kept, lambda x, i: F.array_position(lowered, F.lower(x)) == i + 1)
    return F.slice(first, 1, most)


def ordered_union(lists: Column, most: int = 24) -> Column:
    """Distinct names (case counts) of an array of lists, in order of appearance."""
    return F.slice(F.array_distinct(F.flatten(lists)), 1, most)


def side_of(label: Column, confidence: Column, leaning: Column) -> Column:
    """The article's own LEFT or RIGHT label from confidence 0.6, else the outlet's side."""
    own = label.isin("LEFT", "RIGHT") & (F.coalesce(confidence, F.lit(0.0)) >= 0.6)
    outlet = F.lit(None).cast("string")
    for name, side in SIDES.items():
        outlet = F.when(leaning == name, F.lit(side)).otherwise(outlet)
    return F.when(own, F.lower(label)).otherwise(outlet)


def date_compatible(a: Column, b: Column, days: int) -> Column:
    """At most ``days`` apart; an unknown date fits any."""
    return F.coalesce(F.abs(F.datediff(a, b)) <= days, F.lit(True))


def candidate_score(similarity: Column, jaccard: Column, published: Column, last_seen: Column) -> Column:
    """Similarity, a little for shared entities, less for days apart; rounded to four places, which is what is compared."""
    return F.round(similarity + 0.05 * jaccard - 0.02 * days_apart(published, last_seen), 4)


def verify_reason(published: Column, event_date: Column, first_seen: Column, story_date: Column, config: Config = Config()) -> Column:
    """Why even a strong match needs the verifier; null if it does not."""
    late = micros(published) - micros(first_seen) > config.auto_attach_window_hours * 3_600_000_000
    return F.when(first_seen.isNull(), "no_first_seen").when(late, "late").when(event_date > story_date, "later_event_date")


def zone(score: Column, reason: Column, config: Config = Config()) -> Column:
    """attach, verify or create for the best candidate's score (null: there is none)."""
    return F.when(score >= config.attach_threshold, F.when(reason.isNull(), "attach").otherwise("verify")).when(score >= config.verify_threshold, "verify").otherwise("create")


def can_create(article_type: Column, is_wire: Column) -> Column:
    return F.coalesce(article_type.isin(*CREATING_TYPES), F.lit(False)) & ~F.coalesce(is_wire, F.lit(False))


def verified(relation: Column, confidence: Column, known: Column, keep: Column, config: Config = Config()) -> Column:
    """What a verifier's answer means: ``chosen`` (its candidate), ``kept`` (the strong match stays) or null (no match).

    known: its candidate is one of those shown; keep: there was a strong match, which stays unless the verifier is sure.
    """
    same = (relation == "same_development") & known
    sure = F.coalesce(confidence.try_cast("double"), F.lit(0.0))
    leaves = relation.isin("follow_up", "unrelated") & (sure >= config.split_min_confidence)
    return F.when(F.coalesce(same, F.lit(False)) & (keep | (sure >= config.verify_min_confidence)), "chosen").when(keep & ~F.coalesce(leaves, F.lit(False)), "kept")


def displayable(is_wire: Column, article_type: Column, title: Column) -> Column:
    return ~F.coalesce(is_wire, F.lit(False)) & ~F.coalesce(article_type.isin(*HIDDEN_TYPES), F.lit(False)) & ~is_non_article(title)


def needs_framing(axes: Column, summary: Column) -> Column:
    """No axis that is not blank, or a blank summary."""
    filled = F.filter(F.coalesce(axes, F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    return (F.size(filled) == 0) | (F.coalesce(F.trim(summary), F.lit("")) == "")


def fill_framing(axes: Column, summary: Column, new_axes: Column, new_summary: Column) -> tuple[Column, Column]:
    """(axes, summary) with only what is missing taken from a new answer."""
    tidy = lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
    nothing = F.array().cast("array<string>")
    given = F.slice(F.transform(F.filter(F.coalesce(new_axes, nothing), lambda x: F.trim(x) != ""), tidy), 1, 4)
    has = F.size(F.filter(F.coalesce(axes, nothing), lambda x: F.trim(x) != "")) > 0
    told = F.nullif(tidy(F.coalesce(new_summary, F.lit(""))), F.lit(""))
    return F.when(has | (F.size(given) == 0), axes).otherwise(given), F.when(F.coalesce(F.trim(summary), F.lit("")) != "", summary).otherwise(F.coalesce(told, summary))


def axis_set(axes: Column) -> Column:
    """The distinct axes that are not empty, trimmed and in lower case."""
    kept = F.filter(F.coalesce(axes, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(F.transform(kept, lambda x: F.lower(F.trim(x))))


def pair_terms(left: str, right: str, outlets: Column | None = None, sets: bool = False) -> dict[str, Column]:
    """score and kind of a left and a right article, given as struct columns named ``left`` and ``right``.

    outlets: those of the story's current pair, or null.  sets: the articles carry their ``axis_set``.
    """
    l, r = (lambda f: F.col(f"{left}.{f}")), (lambda f: F.col(f"{right}.{f}"))
    opposed = F.lit(False)
    for a, b in OPPOSED:
        opposed = opposed | (F.coalesce(l("direction") == a, F.lit(False)) & F.coalesce(r("direction") == b, F.lit(False)))
    opposed = opposed & (F.coalesce(l("confidence"), F.lit(0.0)) >= 0.5) & (F.coalesce(r("confidence"), F.lit(0.0)) >= 0.5)
    a, b = (l("axis_set"), r("axis_set")) if sets else (axis_set(l("axes")), axis_set(r("axes")))
    disjoint = (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)
    same = l("article_type").eqNullSafe(r("article_type"))
    clash = F.coalesce(F.array_sort(F.array(l("article_type"), r("article_type"))) == F.array(F.lit("news"), F.lit("opinion")), F.lit(False))
    live = F.coalesce(l("article_type") == "live", F.lit(False)) | F.coalesce(r("article_type") == "live", F.lit(False))
    has = lambda f: (F.coalesce(l(f), F.lit("")) != "") & (F.coalesce(r(f), F.lit("")) != "")
    points = lambda test, n: F.when(test, F.lit(n)).otherwise(F.lit(0.0))
    new = F.lit(False) if outlets is None else F.coalesce((F.size(outlets) > 0) & ~F.arrays_overlap(F.array(l("outlet"), r("outlet")), outlets), F.lit(False))
    score = (
        points(opposed, 3.0) + points(disjoint, 1.5) + F.when(same, 1.0).when(clash, -1.0).otherwise(0.0) + points(live, -1.5)
        + points(has("image_url"), 1.0) + points(has("snippet"), 0.5) - 0.02 * hours_apart(l("published_at"), r("published_at")) + points(new, 0.5)
    )
    kind = F.when(opposed, "opposing_stance").when(disjoint, "framing_contrast").otherwise("same_story")
    return {"score": F.round(score, 3), "kind": kind}


def keeps_current(same: Column, score: Column, current_score: Column, featured: Column, current_featured: Column) -> Column:
    """Hysteresis: a current pair stays if the choice is the same, or neither clearly better nor 12 hours newer and nearly as good."""
    newer = micros(featured) - micros(current_featured) > 12 * 3_600_000_000
    replaced = (score >= current_score + 1.0) | (newer & (score >= current_score - 0.5))
    return same | ~replaced


def survives(a_count: Column, a_first: Column, b_count: Column, b_first: Column) -> Column:
    """True if story a survives a merge: more articles, then seen earlier, then a."""
    return (F.coalesce(a_count, F.lit(0)) > F.coalesce(b_count, F.lit(0))) | ((F.coalesce(a_count, F.lit(0)) == F.coalesce(b_count, F.lit(0))) & (micros(a_first) <= micros(b_first)))


# The names, datelines and credits by which a text counts as agency copy.
WIRE_NAMES = r"(?i)\b(associated press|reuters|agence france-presse|afp|bloomberg news)\b"
WIRE_DATELINE = r"(?m)^\s*(?:[A-Z][A-Za-z.'’\- ]{1,40},?\s*)?\((?:AP|Reuters|AFP|Bloomberg)\)\s*[—–-]"
WIRE_CREDIT = r"(?i)\b(?:AP|Reuters)\b.{0,40}\bcontributed\b|©\s*20\d\d\s*(?:The Associated Press|Reuters)"


def wire_hint(text: Column, authors: Column) -> Column:
    """Agency copy by its dateline, an author's name or the credit at the end."""
    body = F.coalesce(text, F.lit(""))
    by = F.exists(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.coalesce(a.rlike(WIRE_NAMES), F.lit(False)))
    return F.substring(body, 1, 400).rlike(WIRE_DATELINE) | by | F.right(body, F.lit(600)).rlike(WIRE_CREDIT)


def wire_verdict(said: Column, evidence: Column, hint: Column) -> Column:
    """The model's word counts only with evidence; the hint of the page always does."""
    proof = F.coalesce(evidence, F.lit("")).rlike(r"(?i)\b(ap|associated press|reuters|afp|agence france|bloomberg)\b")
    return (F.coalesce(said, F.lit(False)) & proof) | F.coalesce(hint, F.lit(False))
