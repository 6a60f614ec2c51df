"""Technology vocabulary: bounded terms, tagging, canonical names.

A term is bounded on both sides; a lower-case term is searched in any case, one
with a capital in exact case.  Terms made of word characters only are found by
cutting the text into tokens once, others by a regular expression each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks.functions.text import text

Vocabulary = Mapping[str, tuple[str, ...]]

# Canonical names and the spellings that stand for them.
TECHNOLOGIES: Vocabulary = {
    "Python": ("python",),
    "Java": ("java",),
    "JavaScript": ("javascript", "JS"),
    "TypeScript": ("typescript", "TS"),
    "Go": ("golang", "Go"),
    "Rust": ("rust",),
    "Kotlin": ("kotlin",),
    "Swift": ("swift",),
    "Ruby": ("ruby",),
    "PHP": ("php",),
    "Scala": ("scala",),
    "Elixir": ("elixir",),
    "C++": ("c++", "cpp"),
    "C#": ("c#", "csharp"),
    "SQL": ("sql",),
    "Bash": ("bash", "shell scripting"),
    "Django": ("django",),
    "Flask": ("flask",),
    "FastAPI": ("fastapi", "fast api"),
    "Spring": ("spring boot", "springboot", "Spring"),
    "Rails": ("rails", "ruby on rails"),
    "Laravel": ("laravel",),
    "Symfony": ("symfony",),
    "Node.js": ("node.js", "nodejs", "Node"),
    "Express": ("express.js", "expressjs"),
    "NestJS": ("nestjs", "nest.js"),
    "React": ("react", "react.js", "reactjs"),
    "Vue": ("vue.js", "vuejs", "Vue"),
    "Angular": ("angular",),
    "Svelte": ("svelte", "sveltekit"),
    "Next.js": ("next.js", "nextjs"),
    ".NET": (".net", "dotnet", "asp.net"),
    "GraphQL": ("graphql",),
    "gRPC": ("grpc",),
    "REST": ("REST", "restful"),
    "PostgreSQL": ("postgresql", "postgres"),
    "MySQL": ("mysql",),
    "NoSQL": ("nosql", "no-sql"),
    "MongoDB": ("mongodb", "mongo"),
    "Redis": ("redis",),
    "Elasticsearch": ("elasticsearch",),
    "Cassandra": ("cassandra",),
    "DynamoDB": ("dynamodb",),
    "Kafka": ("kafka",),
    "RabbitMQ": ("rabbitmq",),
    "Snowflake": ("snowflake",),
    "BigQuery": ("bigquery",),
    "Spark": ("apache spark", "pyspark", "Spark"),
    "Airflow": ("airflow",),
    "dbt": ("dbt",),
    "AWS": ("aws", "amazon web services"),
    "GCP": ("gcp", "google cloud"),
    "Azure": ("azure",),
    "Kubernetes": ("kubernetes", "k8s"),
    "Docker": ("docker",),
    "Terraform": ("terraform",),
    "Ansible": ("ansible",),
    "Helm": ("helm",),
    "Linux": ("linux",),
    "Git": ("git",),
    "CI/CD": ("ci/cd", "cicd", "continuous integration"),
    "Jenkins": ("jenkins",),
    "Prometheus": ("prometheus",),
    "Grafana": ("grafana",),
}

#: A term's bounds in a posting: a digit may follow ("python3").
LEFT, RIGHT = r"(?<![A-Za-z0-9_+#])", r"(?![A-Za-z_+#])"
#: A word's bounds in titles and locations: no digit may follow.
WORD_LEFT, WORD_RIGHT = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
#: Terms that a token can equal, and tokens after which only a regex is right.
TOKEN_TERM = r"[A-Za-z0-9_+#]*[A-Za-z_+#]"


def quoted(term: str) -> str:
    """A literal for Java's and Python's regular expressions alike."""
    return re.sub(r"([\\.^$*+?{}\[\]|()\-#&~/ ])", lambda m: "\\" + m[1] if m[1] not in "/ #&~-" else m[1], term)


def flagged(pattern: str, term: str) -> str:
    """Exact case where the term has a capital, else any case."""
    return pattern if any(c.isupper() for c in term) else "(?iu)" + pattern


def term_pattern(term: str) -> str:
    return flagged(LEFT + quoted(term) + RIGHT, term)


def word_pattern(term: str) -> str:
    return flagged(WORD_LEFT + quoted(term) + WORD_RIGHT, term)


def by_case(terms: Iterable[str]) -> list[tuple[bool, list[str]]]:
    """The terms that are searched in exact case (True) and in any case."""
    terms = [t for t in terms if t]
    split = [(exact, [t for t in terms if any(ch.isupper() for ch in t) == exact]) for exact in (False, True)]
    return [(exact, some) for exact, some in split if some]


def has_word(c: Column, terms: Iterable[str]) -> Column:
    """Is one of the terms a whole word of the text?  One expression for the
    terms of any case and one for those of exact case."""
    out = F.lit(False)
    for exact, some in by_case(terms):
        either = WORD_LEFT + "(?:" + "|".join(map(quoted, some)) + ")" + WORD_RIGHT
        out = out | text(c).rlike(either if exact else "(?iu)" + either)
    return out


def folded(term: str) -> str:
    return term.upper().lower()


def without_prefixes(terms: list[str]) -> list[list[str]]:
    """The terms in groups, in order, in which none begins with another one."""
    out: list[list[str]] = []
    for t in terms:
        apart = lambda group, t=folded(t): not any(t.startswith(o) or o.startswith(t) for o in map(folded, group))
        group = next(filter(apart, out), None)
        if group is None:
            out.append(group := [])
        group.append(t)
    return out


def occurring(c: Column, terms: list[str], left: str, right: str) -> Column:
    """Numbers (from 1, in the list) of the terms that occur between bounds.

    One pass over a text for the terms of any case and one for those of exact
    case finds a term at each place, also inside another one; terms that begin
    alike, hence could stand at one place, have passes of their own.
    """

    def numbers(exact: bool, some: list[str]) -> Column:
        here = left + "(?=(" + "|".join(map(quoted, some)) + ")" + right + ")"
        hits = F.regexp_extract_all(text(c), F.lit(here if exact else "(?iu)" + here), F.lit(1))
        names = F.array(*[F.lit(t if exact else folded(t)) for t in some])
        place = F.array(*[F.lit(terms.index(t) + 1) for t in some])
        return F.transform(hits, lambda h: F.element_at(place, F.array_position(names, h if exact else F.lower(F.upper(h))).cast("int")))

    groups = [(exact, group) for exact, some in by_case(terms) for group in without_prefixes(some)]
    return F.concat(*[numbers(*g) for g in groups]) if groups else F.array().cast("array<int>")


def first_word(c: Column, terms: Iterable[str]) -> Column:
    """The first term, in the order given, that is a whole word; else null."""
    terms = list(dict.fromkeys(t for t in terms if t))
    if not terms:
        return F.lit(None).cast("string")
    return F.get(F.array(*map(F.lit, terms)), F.array_min(occurring(c, terms, WORD_LEFT, WORD_RIGHT)) - 1)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tag(c: Column, vocabulary: Vocabulary = TECHNOLOGIES) -> Column:
    """Canonical names whose terms occur in a text, sorted without case.

    The text is cut once into runs of term characters; the runs, less trailing
    digits, are intersected once with all single-token terms, so a long text
    costs one pass whatever the vocabulary's size.  Where letters follow digits
    inside a run ("python3x"), which the cut cannot judge, and for terms with
    other characters, bounded regular expressions decide, in one pass too.
    """
    names = sorted(vocabulary, key=str.lower)
    if not names:
        return F.array().cast("array<string>")
    s = text(c)
    of: dict[str, list[int]] = {}  # numbers of the names of a term
    for i, n in enumerate(names):
        for t in filter(None, vocabulary[n]):
            of.setdefault(t, []).append(i)
    token = [t for t in of if re.fullmatch(TOKEN_TERM, t)]
    other = [t for t in of if t not in set(token)]
    none = F.array().cast("array<int>")

    def named(found: Column, terms: list[str]) -> Column:
        """Numbers of names for numbers of terms (from 1)."""
        table = F.array(*[F.array(*map(F.lit, of[t])) for t in terms])
        return F.flatten(F.transform(found, lambda k: F.element_at(table, k)))

    def equal(exact: bool, terms: list[str]) -> Column:
        listed = F.array(*map(F.lit, terms))
        bare = F.regexp_replace(s if exact else F.lower(s), r"(?<![0-9])[0-9]++(?![A-Za-z0-9_+#])", "")
        runs = F.regexp_extract_all(bare, F.lit("[A-Za-z0-9_+#]+"), F.lit(0))  # split() compiles its pattern for each row
        return named(F.transform(F.array_intersect(runs, listed), lambda h: F.array_position(listed, h).cast("int")), terms)

    found = [equal(*group) for group in by_case(token)]
    if token:
        found.append(F.when(s.rlike(r"[A-Za-z_+#][0-9]+[A-Za-z_+#]"), named(occurring(s, token, LEFT, RIGHT), token)).otherwise(none))
    if other:
        found.append(named(occurring(s, other, LEFT, RIGHT), other))
    numbers = F.array_sort(F.array_distinct(F.concat(*found))) if found else none
    listed = F.array(*map(F.lit, names))
    return F.transform(numbers, lambda i: F.get(listed, i))


def tag_posting(title: Column, description: Column, vocabulary: Vocabulary = TECHNOLOGIES) -> Column:
    """Names in a posting's title and description."""
    return tag(F.concat(text(title), F.lit("\n"), text(description)), vocabulary)


def alias_index(vocabulary: Vocabulary) -> dict[str, str]:
    """Lower-case spelling -> canonical name; a canonical name wins over any
    spelling, among spellings the first name in order."""
    index: dict[str, str] = {}
    for name in sorted(vocabulary):
        for spelling in vocabulary[name]:
            index.setdefault(spelling.lower(), name)
    # later canonical names replace earlier spellings, as each name claims its own
    return index | {name.lower(): name for name in sorted(vocabulary)}


def canonical(terms: Iterable[str], vocabulary: Vocabulary = TECHNOLOGIES) -> list[str]:
    """Canonical names of configured terms, blank ones left out, in order."""
    index = alias_index(vocabulary)
    return list(dict.fromkeys(index.get(t.strip().lower(), t.strip()) for t in terms if t.strip()))


def extended(terms: Iterable[str], vocabulary: Vocabulary = TECHNOLOGIES) -> dict[str, tuple[str, ...]]:
    """The vocabulary plus every configured term that it does not know, to be
    found in any case; of spellings that differ in case the first counts."""
    index, extra = alias_index(vocabulary), {}
    for t in map(str.strip, terms):
        if t and t.lower() not in index:
            index[t.lower()] = t
            extra[t] = (t.lower(),)
    return dict(vocabulary) | extra
