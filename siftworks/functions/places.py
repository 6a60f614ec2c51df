"""Zones, seniority levels and other word tables of the rules."""

from __future__ import annotations

from collections.abc import Mapping

# What a title calls each seniority level.
LEVELS: Mapping[str, tuple[str, ...]] = {
    "intern": (
        "intern", "internship", "stagiaire", "trainee", "apprentice", "apprenti", "alternance", "alternant",
        "working student", "werkstudent",
    ),
    "junior": (
        "junior", "jr", "graduate", "new grad", "entry level", "entry-level", "débutant", "debutant", "I",
    ),
    "mid": (
        "mid", "mid-level", "midlevel", "intermediate", "confirmé", "confirme", "II",
    ),
    "senior": (
        "senior", "sénior", "sr", "expérimenté", "experimente", "III", "IV",
    ),
    "staff": (
        "staff",
    ),
    "principal": (
        "principal", "distinguished", "fellow",
    ),
    "lead": (
        "lead", "tech lead", "team lead", "techlead",
    ),
    "manager": (
        "manager", "head of", "director", "vp of", "vp,",
    ),
}

# Terms of each zone, in the order they are tried; zones are disjoint.
ZONES: Mapping[str, tuple[str, ...]] = {
    "asia": (
        "apac", "japan", "japon", "tokyo", "osaka", "kyoto", "singapore", "singapour", "hong kong", "korea", "seoul",
        "taiwan", "taipei", "vietnam", "hanoi", "ho chi minh", "indonesia", "jakarta", "philippines", "manila",
        "malaysia", "kuala lumpur", "thailand", "bangkok", "india", "bangalore", "bengaluru", "jst", "sgt",
    ),
    "europe": (
        "emea", "eu", "cet", "cest", "uk", "united kingdom", "london", "ireland", "dublin", "germany", "deutschland",
        "berlin", "munich", "hamburg", "netherlands", "amsterdam", "utrecht", "spain", "madrid", "barcelona",
        "valencia", "portugal", "lisbon", "lisboa", "porto", "italy", "milan", "rome", "poland", "warsaw", "krakow",
        "sweden", "stockholm", "denmark", "copenhagen", "norway", "oslo", "finland", "helsinki", "switzerland",
        "zurich", "geneva", "austria", "vienna", "belgium", "brussels", "czech", "prague", "romania", "bucharest",
        "greece", "athens", "estonia", "tallinn", "lithuania", "latvia", "hungary", "budapest", "bulgaria", "sofia",
    ),
    "france": (
        "fr", "french", "française", "francaise", "paris", "lyon", "marseille", "toulouse", "bordeaux", "lille",
        "nantes", "nice", "strasbourg", "rennes", "montpellier", "grenoble", "sophia antipolis",
    ),
}

# Words that name no place.
NEUTRAL_WORDS = (
    "remote", "remotely", "anywhere", "worldwide", "world", "global", "globally", "international", "distributed",
    "fully", "full", "first", "only", "work", "from", "home", "wfh", "any", "location", "locations", "flexible",
    "in", "the", "of", "or", "and", "télétravail", "teletravail", "complet", "total", "partout", "monde", "dans",
    "le", "la", "en", "à", "a",
)
