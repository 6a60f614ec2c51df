"""Publication: cards as Markdown, a capped and idempotent plan, the registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from siftworks.functions.dates import day_of
from siftworks.functions.text import squash, strip, text

# Fixed values of the card format.
UNTITLED = "(poste sans titre)"
MODES = {"remote": "télétravail", "hybrid": "hybride", "onsite": "sur site"}
LONGEST_BODY = 25_000
CUT_NOTE = "… (description tronquée — la suite est sur le lien ATS)"
JOINER = "⁠"
ACTIVE_MARKDOWN = r"([\\`*_\[\]<>~&|])"
LONGEST_TITLE = 256

#: Mark of a card's id; a board with cards of another mark is read with that.
ID_MARK = "posting:id="
#: Calls of one run, and how far a search for a half-made card looks back.
CAP = 50
RECOVERY_MINUTES = 10


def escaped(c: Column) -> Column:
    """One line, inert in Markdown: active signs escaped, mentions broken."""
    return F.regexp_replace(F.regexp_replace(squash(c), ACTIVE_MARKDOWN, r"\\$1"), r"(?U)([@#])(?=\w)", "$1" + JOINER)


def card_title(company: Column, title: Column) -> Column:
    job = F.when(strip(title) == "", F.lit(UNTITLED)).otherwise(strip(title))
    return F.when(strip(company) == "", job).otherwise(F.concat(strip(company), F.lit(" — "), job))


def short_title(c: Column) -> Column:
    """One line of at most 256 characters, cut with an ellipsis."""
    line = squash(c)
    cut = F.concat(F.regexp_replace(F.substring(line, 1, LONGEST_TITLE - 1), r"(?U)\s+$", ""), F.lit("…"))
    return F.when(F.length(line) > LONGEST_TITLE, cut).otherwise(line)


def body_markdown(c: Column) -> Column:
    """A description as paragraphs, each line inert, long ones cut."""
    whole = strip(c)
    cut = F.when(F.length(whole) > LONGEST_BODY, F.concat(F.regexp_replace(F.substring(whole, 1, LONGEST_BODY), r"(?U)\s+$", ""), F.lit(CUT_NOTE))).otherwise(whole)
    lines = F.transform(F.split(cut, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: F.regexp_replace(escaped(x), r"^(#|[-=](?=[-=\s]*$))", r"\\$1"))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n\n")


def link(url: Column) -> Column:
    """A clickable link for an ordinary web URL, else the inert text."""
    u = strip(url)
    host = F.lower(F.regexp_extract(u, r"^(?i:https?)://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))
    fine = (host != "") & ~u.rlike(r"[<>\\]") & ~u.rlike(r"(?U)[\p{C}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]")
    return F.when(fine, F.concat(F.lit("["), escaped(host), F.lit("](<"), F.replace(u, F.lit(" "), F.lit("%20")), F.lit(">)"))).otherwise(escaped(u))


@pandas_udf(StringType())
def comment_safe(s: pd.Series) -> pd.Series:
    """An id as it can stand in a comment; :func:`marked_id` undoes it."""
    from urllib.parse import quote

    return s.map(lambda x: quote(x or "", safe=":-").replace("--", "-%2D"))


@pandas_udf(StringType())
def unquoted(s: pd.Series) -> pd.Series:
    from urllib.parse import unquote

    return s.map(lambda x: None if x is None else unquote(x))


def marked_id(body: Column, mark: str = ID_MARK) -> Column:
    """The id in a card's mark; null where there is none."""
    found = F.regexp_extract(text(body), f"<!-- \\Q{mark}\\E(\\S+) -->", 1)
    return unquoted(F.nullif(found, F.lit("")))


def card_body(p: dict[str, Column], mark: str = ID_MARK) -> Column:
    """Markdown of a posting's card from columns: company, title, location,
    remote_type, score, reason, tech, url, date, source, description, stable_id."""
    mode = F.create_map(*[F.lit(x) for kv in MODES.items() for x in kv])
    place = F.array_join(F.filter(F.array(escaped(p["location"]), F.coalesce(F.try_element_at(mode, text(p["remote_type"])), F.lit(""))), lambda x: x != ""), " · ")
    rating = F.concat(p["score"].cast("string"), F.when(text(p["reason"]) == "", F.lit("")).otherwise(F.concat(F.lit(" — "), text(p["reason"]))))
    fields = [
        ("Entreprise", escaped(p["company"])),
        ("Poste", escaped(p["title"])),
        ("Localisation", place),
        ("Score", escaped(rating)),
        ("Tech", escaped(F.array_join(F.filter(p["tech"], lambda t: strip(t) != ""), ", "))),
        ("Lien ATS", link(p["url"])),
        ("Publiée le", day_of(p["date"])),
        ("Source", escaped(p["source"])),
    ]
    lines = F.filter(F.array(*[F.when(v != "", F.concat(F.lit(f"**{k}** : "), v, F.lit("  "))) for k, v in fields]), lambda x: x.isNotNull())
    described = body_markdown(p["description"])
    block = F.when(described == "", F.lit("")).otherwise(F.concat(F.lit("---\n\n**Description**\n\n"), described, F.lit("\n\n")))
    end = F.concat(F.lit(f"<!-- {mark}"), comment_safe(p["stable_id"]), F.lit(" -->\n"))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(lines) > 0, F.lit("\n\n")).otherwise(F.lit("\n")), block, end)


def needs_call(registry: DataFrame) -> Column:
    """Does a posting (left-joined to the registry) still need a call: no card,
    one under way, or one to be put on the board?"""
    issue, item, pending, off = (registry[c] for c in ("issue", "item", "pending_since", "off_board"))
    return issue.isNull() | pending.isNotNull() | (item.isNull() & ~F.coalesce(off, F.lit(False)))


def plan(ranked: DataFrame, registry: DataFrame, *order: str, cap: int = CAP) -> DataFrame:
    """Ranked postings with ``outcome``: complete, publish or defer.

    The first ``cap`` postings that need a call are published, later ones
    deferred; complete ones pass whatever the cap.  Exact as long as no call
    fails; :func:`run_plan` handles failures.  The cap is a top-k of the
    postings that need a call, so no task sees all of them.
    """
    reg = registry.select("stable_id", "issue", "item", "pending_since", "off_board", F.lit(True).alias("__there"))
    rows = ranked.join(reg, "stable_id", "left")
    call = F.col("__there").isNull() | needs_call(rows)
    rows = rows.withColumn("needs_call", call)
    chosen = rows.where("needs_call").orderBy(*order).limit(cap).select(*[F.col(c).alias(f"__{c}") for c in ("stable_id", *order)])
    same = [rows[c].eqNullSafe(chosen[f"__{c}"]) for c in ("stable_id", *order)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    # at most ``cap`` rows are on the right
    picked = rows.join(F.broadcast(chosen.withColumn("__picked", F.lit(True))), on, "left")
    outcome = F.when(~F.col("needs_call"), "complete").when(F.col("__picked"), "publish").otherwise("defer")
    return picked.withColumn("outcome", outcome).select(*ranked.columns, "needs_call", "outcome")


class CallRefused(Exception):
    """The service will never take this posting."""


@dataclass
class Run:
    """What a run did, by stable id, in order."""

    published: list[str] = field(default_factory=list)
    complete: list[str] = field(default_factory=list)
    refused: list[str] = field(default_factory=list)
    deferred: list[str] = field(default_factory=list)
    error: str = ""

    @property
    def treated(self) -> list[str]:
        """Ids to remember as seen; deferred ones come again."""
        return self.published + self.complete + self.refused


def run_plan(rows: Iterable, publish: Callable[[object], bool], cap: int = CAP) -> Run:
    """Carry a plan out on the driver: side effects in order, no task retries.

    ``rows`` have stable_id and needs_call, ranked.  ``publish(row)`` makes the
    card and says whether it made or placed one.  A refusal counts as treated
    and does not use the cap; after any other failure everything later is
    deferred, complete postings too.
    """
    out = Run()
    for row in rows:
        ident = row["stable_id"]
        if out.error or row["needs_call"] and len(out.published) >= cap:
            out.deferred.append(ident)
        elif not row["needs_call"]:
            out.complete.append(ident)
        else:
            try:
                (out.published if publish(row) else out.complete).append(ident)
            except CallRefused:
                out.refused.append(ident)
            except Exception as e:  # an outage stops the run, what was done is kept
                out.error = f"{type(e).__name__}: {e}"
                out.deferred.append(ident)
    return out


def card_state(registry: DataFrame) -> Column:
    """absent, pending, to_place, complete or off_board."""
    return (
        F.when(registry["pending_since"].isNotNull(), "pending")
        .when(registry["issue"].isNull(), "absent")
        .when(F.coalesce(registry["off_board"], F.lit(False)), "off_board")
        .when(registry["item"].isNull(), "to_place")
        .otherwise("complete")
    )


def card_states(events: DataFrame, *, key: str = "stable_id", kind: str = "kind", order: tuple[str, ...] = ("at",)) -> DataFrame:
    """stable_id, state, pending_since (first field of ``order``) of cards from
    the events of their making: ``intent``, ``failed`` (it certainly was not
    made), ``lost`` (it may have been), ``created``, ``placed``, ``removed`` (by
    hand).

    A card that was created stays so; before, an intent that no failure followed
    is pending, and a lost answer leaves it so.  On or off the board is what
    came last after the creation; events of a place before it, and kinds that
    are not listed, change nothing.  All that counts of a card's events are some
    first and last places in their order, so the fold is one aggregate that is
    combined before its shuffle, however many events a card has.
    """
    at = F.struct(*order)
    of = lambda *kinds: F.when(F.col(kind).isin(*kinds), at)
    rows = events.groupBy(F.col(key).alias("stable_id")).agg(
        F.min(of("created")).alias("made"), F.max(of("intent")).alias("meant"), F.max(of("failed")).alias("failed"), F.max(of("placed")).alias("placed"), F.max(of("removed")).alias("removed")
    )
    later = lambda a, b: F.col(a).isNotNull() & F.coalesce(F.col(a) > F.col(b), F.lit(True))
    on, off = later("placed", "removed") & (F.col("placed") > F.col("made")), F.col("removed") > F.col("made")
    pending = F.col("made").isNull() & later("meant", "failed")
    state = F.when(F.col("made").isNull(), F.when(pending, "pending").otherwise("absent")).when(on, "complete").when(off, "off_board").otherwise("to_place")
    return rows.select("stable_id", state.alias("state"), F.when(pending, F.col("meant")[order[0]]).alias("pending_since"))


def in_recovery_window(created: Column, pending_since: Column) -> Column:
    """May a card made at ``created`` be the one that was under way?"""
    return created >= pending_since - F.make_interval(mins=F.lit(RECOVERY_MINUTES))


def cards(issues: DataFrame, mark: str = ID_MARK) -> DataFrame:
    """stable_id, issue, node_id of issues (number, node_id, body,
    is_pull_request): pull requests and unmarked ones left out, the lowest
    number of each id."""
    rows = issues.where(~F.coalesce("is_pull_request", F.lit(False))).withColumn("stable_id", marked_id(F.col("body"), mark)).where("stable_id is not null")
    return rows.groupBy("stable_id").agg(F.min_by(F.struct("number", "node_id"), "number").alias("first")).select("stable_id", F.col("first.number").alias("issue"), F.col("first.node_id").alias("node_id"))


def board_items(items: DataFrame, repository: str) -> DataFrame:
    """number, item of a repository's board (repo compared without case); the
    last item of a number in ``pos`` order."""
    return items.where(F.lower("repo") == repository.lower()).groupBy("number").agg(F.max_by("item", "pos").alias("item"))


def rebuild(issues: DataFrame, items: DataFrame, repository: str, mark: str = ID_MARK) -> DataFrame:
    """The registry from the service: marked issues with their items; an issue
    without one is off the board."""
    placed = board_items(items, repository)
    return cards(issues, mark).join(placed, F.col("issue") == F.col("number"), "left").select("stable_id", "issue", "node_id", "item", F.col("item").isNull().alias("off_board"))


def outcome_counts(planned: DataFrame) -> DataFrame:
    return planned.groupBy("outcome").agg(F.count("*").alias("n"))
