"""Small inputs with their expected results, written by hand."""

from __future__ import annotations

import json

#: k, location, remote_type.
LOCATIONS = [
    (0, "Remote", "remote"),
    (1, "", "remote"),
    (2, "Remote, Canada", "remote"),
    (3, "Anywhere in the world", "remote"),
    (4, "Anywhere in the US", "remote"),
    (5, "100% Remote (Worldwide)", "remote"),
    (6, "Télétravail complet", "remote"),
    (7, "Remote", "hybrid"),
    (8, "Tokyo, JP", "onsite"),
    (9, "Paris, FR", "onsite"),
    (10, "Berlin or Paris", "remote"),
    (11, "Singapore / London / Lyon", "hybrid"),
    (12, "Europe", "unknown"),
    (13, "Neuilly", "onsite"),
    (14, "Hong Kong", "unknown"),
    (15, "franco-portuguese", "onsite"),
    (16, "EMEA remote", "remote"),
    (17, "Remote - EU", "remote"),
]

#: k, text.
TECH_TEXTS = [
    (0, "Senior Python3 developer, Django and PostgreSQL"),
    (1, "go to market, express yourself, rest assured"),
    (2, "We use Go, REST and Node on AWS"),
    (3, "C++11, C# and .NET; also node.js / next.js"),
    (4, "javascripting is not it, nor pythonic or mysqld"),
    (5, "Ruby on Rails, CI/CD, k8s"),
    (6, "ruby-on-rails react.js spring boot"),
    (7, "python3x and kafka2 spark Spark apache spark"),
    (8, "gRPC+REST, C/C++"),
    (9, "nothing here"),
    (10, "NoSQL no-sql sql_mode SQL"),
    (11, "élasticsearch git, github gitlab"),
]

#: name, slug.
SLUGS = [
    ("Société Générale", "societe-generale"),
    ("GitLab", "gitlab"),
    ("  --Big  Corp.--", "big-corp"),
    ("Łódź ß ﬁ", "odz-fi"),
    ("日本", ""),
    ("A:B/C", "a-b-c"),
    ("", ""),
]

#: raw, ISO.
DATES = [
    ("2026-09-05T10:20:30Z", "2026-09-05T10:20:30+00:00"),
    ("2026-09-05T10:20:30+02:00", "2026-09-05T08:20:30+00:00"),
    ("2026-09-05T10:20:30.123456Z", "2026-09-05T10:20:30+00:00"),
    ("2026-09-05", "2026-09-05T00:00:00+00:00"),
    ("2026-09-05 10:20:30", "2026-09-05T10:20:30+00:00"),
    ("Mon, 17 Aug 2026 19:21:19 +0000", "2026-08-17T19:21:19+00:00"),
    ("Mon, 17 Aug 2026 19:21:19 +0200", "2026-08-17T17:21:19+00:00"),
    ("Mon, 7 Aug 2026 19:21:19 GMT", "2026-08-07T19:21:19+00:00"),
    ("1785760723", "2026-08-03T12:38:43+00:00"),
    ("1785760723000", "2026-08-03T12:38:43+00:00"),
    ("2026", ""),
    ("20260408", "2026-04-08T00:00:00+00:00"),
    ("yesterday", ""),
    ("", ""),
    (None, ""),
    (" 2026-09-05T10:20:30Z ", "2026-09-05T10:20:30+00:00"),
    ("2026-13-45", ""),
]

#: location, work mode.
MODES = [
    ("Remote - Europe", "remote"),
    ("Hybrid (Paris)", "hybrid"),
    ("hybride, remote possible", "remote"),
    ("On-site Berlin", "onsite"),
    ("sur site", "onsite"),
    ("TÉLÉTRAVAIL", "remote"),
    ("Paris", "unknown"),
    ("", "unknown"),
    (None, "unknown"),
]

#: a feed's name of a mode, ours.
MODE_NAMES = [("Remote", "remote"), ("fully_remote", "remote"), ("On-Site", "onsite"), ("in office", "onsite"), (" HYBRID ", "hybrid"), ("unspecified", "unknown"), ("", "unknown"), (None, "unknown")]

#: headline, (company, title, location).
HEADLINES = [
    ("Acme | Engineer | Berlin", ("Acme", "Engineer", "Berlin")),
    ("Acme (https://acme.io) | Senior Engineer | REMOTE | Full-time | $100k", ("Acme (", "Senior Engineer", "REMOTE")),
    ("Acme https://acme.io - | Dev | Remote | Paris, France", ("Acme", "Dev", "Paris, France")),
    ("just a sentence without bars", ("", "just a sentence without bars", "")),
    ("Acme | Dev | Full time | 120k-150k | www.acme.io", ("Acme", "Dev", "")),
    ("Acme || Dev || Onsite (London)", ("Acme", "Dev", "Onsite (London)")),
]

#: as read, as meant.
MOJIBAKE = [("â\x80\x99s cafÃ© Ã\xa0 la", "’s café à la"), ("déjà vu", "déjà vu"), ("", ""), ("Â© 2024", "© 2024"), ("Ã", "Ã")]

ROBOTS = """
# general
User-agent: *
Disallow: /

User-agent: otherbot
User-agent: siftbot
Disallow: /en/
Disallow: /*?page=
Allow: /en/8
Disallow: /*ref=x$
Allow: /e%6E/7
Allow: /en/a%20b+
Disallow: /*/caf%c3%a9
Crawl-delay: x
Crawl-delay: 2.5

Sitemap: https://x.example.com/sitemap.xml
"""
#: kind, pattern, regex for an engine without look-around.
ROBOTS_RULES = [("disallow", "/en/", "^/en/"), ("disallow", "/*?page=", "^/.*\\?page="), ("allow", "/en/8", "^/en/8"), ("disallow", "/*ref=x$", "^/.*ref=x$"), ("allow", "/e%6E/7", "^/en/7"), ("allow", "/en/a%20b+", "^/en/a b\\+"), ("disallow", "/*/caf%c3%a9", "^/.*/café")]

FEED_COLUMNS = ["source", "id", "company", "title", "location", "remote_type", "url", "date", "description"]

RSS = """<?xml version="1.0"?><rss xmlns:c="http://c.example/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>feed</title>{}</channel></rss>"""


def payload(value) -> str:
    return json.dumps(value, ensure_ascii=False)


PAYLOADS = {
    "greenhouse": payload({"jobs": [
        {"id": 7, "title": " Dev ", "location": {"name": "Remote, EU"}, "absolute_url": "", "first_published": None, "updated_at": "2026-09-05T10:20:30Z", "content": "&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;&lt;ul&gt;&lt;li&gt;one&lt;/li&gt;&lt;/ul&gt;"},
        {"id": 8, "title": "", "location": None},
        "no object",
    ]}),
    "lever": payload([{"id": "l1", "text": "Dev", "categories": {"allLocations": ["Paris", " Lyon", "Paris"], "location": "X"}, "hostedUrl": "https://l/1", "workplaceType": "on_site", "createdAt": 1785760723000, "descriptionPlain": "Intro", "lists": [{"text": "Need", "content": "<li>SQL</li>"}, {"text": "", "content": ""}], "additional": "<p>More</p>"}]),
    "ashby": payload({"jobs": [{"id": "a1", "title": "Dev", "location": "Berlin", "secondaryLocations": [{"location": "Paris"}, {"location": "Berlin"}], "isRemote": True, "workplaceType": "Hybrid", "jobUrl": "https://a/1", "publishedAt": "2026-09-05T10:20:30+02:00", "descriptionHtml": "<b>Yes</b>"}]}),
    "smartrecruiters": payload({"content": [
        {"id": "s1", "name": "Dev", "releasedDate": "2026-09-05T10:20:30Z", "location": {"city": "Lyon", "region": "ARA", "country": "fr", "remote": False}},
        {"id": "s2", "name": "Ops", "location": {"fullLocation": "Paris, France", "hybrid": True}},
    ]}),
    "workable": payload({"results": [{"id": 5, "shortcode": "AB", "title": "Dev", "remote": True, "workplace": "other", "published": "2026-09-05", "locations": [{"city": "Rome", "region": "", "country": "Italy", "hidden": False}, {"city": "Oslo", "country": "Norway", "hidden": True}]}]}),
    "remoteok": payload([{"legal": "terms"}, {"id": "9", "position": "Dev", "company": "Acme", "location": ", Worldwide ,", "url": "", "apply_url": "https://r/9", "epoch": 1785760723, "description": "cafÃ©"}, {"id": "10", "position": "Dev", "company": ""}]),
    "remotive": payload({"jobs": [{"id": 3, "title": "Dev", "company_name": "Acme", "candidate_required_location": "Europe", "url": "https://m/3", "publication_date": "2026-09-05T10:20:30", "description": "<p>a</p>"}]}),
    "himalayas": payload({"jobs": [{"guid": "https://h/jobs/dev-1/", "title": "Dev", "companyName": "Acme", "locationRestrictions": ["Spain", "Italy"], "pubDate": 1785760723, "excerpt": "short"}]}),
    "workingnomads": payload([{"url": "https://w/job/go/42/", "title": "Dev", "company_name": "Acme", "location": "Hybrid, Rome", "pub_date": "2026-09-05", "description": ""}, {"url": "https://w/else", "title": "Dev", "company_name": "Acme"}]),
    "landingjobs": payload([{"id": 6, "title": "Dev", "url": "https://l/at/big-data-CORP/dev", "remote": False, "published_at": "2026-09-05", "locations": [{"city": "Lisbon", "country_code": "PT"}], "role_description": "<p>Role</p>", "main_requirements": "", "nice_to_have": "Nice"}]),
    "freework": payload({"hydra:totalItems": 1, "hydra:member": [{"id": 4, "title": "Dev", "slug": "dev-4", "job": {"slug": "data"}, "company": {"name": "Acme"}, "location": {"label": "Lille"}, "remoteMode": "partial", "publishedAt": "2026-09-05", "description": "x"}]}),
    "apec": payload({"totalCount": 2, "resultats": [{"id": 1, "numeroOffre": "N1", "intitule": "Dev", "nomCommercial": "Acme", "lieuTexte": "Nice", "texteOffre": "t", "datePublication": "", "dateValidation": "2026-09-05"}, {"id": 2, "intitule": "Dev", "nomCommercial": ""}]}),
    "hackernews": payload({"id": 1, "children": [{"id": 11, "text": "Acme | Dev | Remote<p>Join &amp; build", "created_at": "2026-09-05T10:20:30Z", "children": []}, {"id": 12, "text": None}]}),
    "weworkremotely": RSS.format("<item><title>Acme: Dev: Senior</title><link>https://w/jobs/dev/</link><region>Anywhere</region><pubDate>Mon, 17 Aug 2026 19:21:19 +0000</pubDate><description>&lt;p&gt;a&lt;/p&gt;</description></item>"),
    "nodesk": RSS.format("<item><title>Dev at Home at Acme</title><link></link><guid>https://n/dev-9</guid><pubDate>2026-09-05</pubDate><description>it&rsquo;s &amp;amp; ok</description></item>"),
    "jobspresso": RSS.format("<item><title>Dev</title><link>https://j/dev/</link><c:company>Acme</c:company><c:location>On site, Bonn</c:location><post-id>77</post-id><content:encoded>full</content:encoded><description>cut</description></item>"),
    "euremotejobs": RSS.format("<item><title>Dev</title><link>https://e/dev-x/</link><company>Acme</company><location>Remote</location></item><item><title>Dev</title><link>https://e/none/</link></item>"),
}

AT, DAY, EPOCH = "2026-09-05T10:20:30+00:00", "2026-09-05T00:00:00+00:00", "2026-08-03T12:38:43+00:00"
FEED_ROWS = [
    ("greenhouse", "7", "Acme", "Dev", "Remote, EU", "remote", "https://boards.greenhouse.io/acme/jobs/7", AT, "Hi & bye\n\n- one"),
    ("lever", "l1", "Acme", "Dev", "Paris; Lyon", "onsite", "https://l/1", EPOCH, "Intro\n\nNeed\n- SQL\n\nMore"),
    ("ashby", "a1", "Acme", "Dev", "Berlin; Paris", "hybrid", "https://a/1", "2026-09-05T08:20:30+00:00", "Yes"),
    ("smartrecruiters", "s1", "Acme", "Dev", "Lyon; ARA; FR", "onsite", "https://jobs.smartrecruiters.com/acme/s1", AT, ""),
    ("smartrecruiters", "s2", "Acme", "Ops", "Paris, France", "hybrid", "https://jobs.smartrecruiters.com/acme/s2", "", ""),
    ("workable", "5", "Acme", "Dev", "Rome, Italy", "remote", "https://apply.workable.com/acme/j/AB/", DAY, ""),
    ("remoteok", "9", "Acme", "Dev", "Worldwide", "remote", "https://r/9", EPOCH, "café"),
    ("remotive", "3", "Acme", "Dev", "Europe", "remote", "https://m/3", AT, "a"),
    ("himalayas", "dev-1", "Acme", "Dev", "Spain; Italy", "remote", "https://h/jobs/dev-1/", EPOCH, "short"),
    ("workingnomads", "42", "Acme", "Dev", "Hybrid, Rome", "hybrid", "https://w/job/go/42/", DAY, ""),
    ("landingjobs", "6", "Big Data Corp", "Dev", "Lisbon, PT", "unknown", "https://l/at/big-data-CORP/dev", DAY, "Role\n\nNice"),
    ("freework", "4", "Acme", "Dev", "Lille", "hybrid", "https://www.free-work.com/fr/tech-it/data/job-mission/dev-4", DAY, "x"),
    ("apec", "N1", "Acme", "Dev", "Nice", "unknown", "https://www.apec.fr/candidat/recherche-emploi.html/emploi/detail-offre/N1", DAY, "t"),
    ("hackernews", "11", "Acme", "Dev", "Remote", "remote", "https://news.ycombinator.com/item?id=11", AT, "Acme | Dev | Remote\nJoin & build"),
    ("weworkremotely", "dev", "Acme", "Dev: Senior", "Anywhere", "remote", "https://w/jobs/dev/", "2026-08-17T19:21:19+00:00", "a"),
    ("nodesk", "dev-9", "Acme", "Dev at Home", "", "remote", "https://n/dev-9", DAY, "it’s & ok"),
    ("jobspresso", "77", "Acme", "Dev", "On site, Bonn", "onsite", "https://j/dev/", "", "full"),
    ("euremotejobs", "dev-x", "Acme", "Dev", "Remote", "remote", "https://e/dev-x/", "", ""),
]

SCRIPT = '<html><script type="application/ld+json">{}</script>{}</html>'
JOB_PAGES = [
    ("https://p/jobs/one/", SCRIPT.format("{broken", '<SCRIPT id=x type = \'application/ld+json\'>' + payload({"@graph": [{"@type": "WebSite"}, {"@type": ["Thing", "jobposting"], "title": "Dev", "identifier": {"value": 12}, "hiringOrganization": [{"x": 1}, {"name": "Acme"}], "jobLocation": [{"address": {"addressLocality": "Tokyo", "addressCountry": "JP"}}, {"address": {"addressLocality": "Tokyo"}}], "datePosted": "2026-09-05", "employmentType": "full-time", "description": "<p>Work</p>"}]}) + "</SCRIPT>")),
    ("https://p/jobs/two", SCRIPT.format(payload([{"@type": "JobPosting", "title": "Ops", "hiringOrganization": "Beta", "jobLocationType": "telecommute", "url": "https://p/2", "jobLocation": "Anywhere", "employmentType": "GIG"}]), "")),
    ("https://p/jobs/three", SCRIPT.format(payload({"@type": "Organization", "name": "x"}), "")),
    ("https://p/jobs/four", "<html>no data</html>"),
    ("https://p/jobs/five", None),
]
PAGE_ROWS = [
    ("12", "pages", "Acme", "Dev", "Tokyo, JP", "unknown", "https://p/jobs/one/", DAY, "Type de contrat : temps plein (FULL_TIME)\n\nWork"),
    ("2", "pages", "Beta", "Ops", "Anywhere", "remote", "https://p/2", "", "Type de contrat : GIG"),
]

#: name, rows, state; and the payload of each, None where nothing came.
HEALTH = [("fine", 1, "ok"), ("void", 0, "empty"), ("broken", 0, "failed"), ("silent", 0, "empty"), ("shapeless", 0, "failed")]
HEALTH_PAYLOADS = [("fine", PAYLOADS["remotive"]), ("void", '{"jobs": []}'), ("broken", "<html>"), ("silent", None), ("shapeless", '{"jobs": 3}')]

#: name, feed, token, problem.
REGISTRY = [
    ("Acme", "greenhouse", "acme", None),
    ("Acme", "greenhouse", None, "token"),
    ("Acme", "greenhouse", "", "token"),
    (None, "greenhouse", "acme", "nom"),
    ("Acme", None, "acme", "ats"),
    ("Acme", "nobody", "acme", "unknown"),
    ("Remotive", "remotive", None, None),
    ("", "", "", "nom"),
]

#: url, link.
LINKS = [
    ("https://jobs.acme.io/a_b?x=1", "[jobs.acme.io](<https://jobs.acme.io/a_b?x=1>)"),
    (" http://acme.io/a b ", "[acme.io](<http://acme.io/a%20b>)"),
    ("javascript:alert(1)", "javascript:alert(1)"),
    ("https://x.io/<b>", "https://x.io/\\<b\\>"),
    ("https://", "https://"),
    ("", ""),
    ("HTTPS://Acme.IO/x", "[acme.io](<HTTPS://Acme.IO/x>)"),
]

CARD_SCHEMA = "company string, title string, location string, remote_type string, score int, reason string, tech array<string>, url string, date string, source string, description string, stable_id string"
CARD_ROW = ("Big *Corp*", "Dev @home", "Paris", "hybrid", 70, "europe", ["Go", " ", "C#"], "https://b.io/1", "2026-09-05T10:20:30+00:00", "li", "# Head\n\n---\nline #1 & more", "li:big-corp:a--b c")
CARD = (
    "**Entreprise** : Big \\*Corp\\*  \n**Poste** : Dev @⁠home  \n**Localisation** : Paris · hybride  \n**Score** : 70 — europe  \n"
    "**Tech** : Go, C#  \n**Lien ATS** : [b.io](<https://b.io/1>)  \n**Publiée le** : 2026-09-05  \n**Source** : li  \n\n"
    "---\n\n**Description**\n\n\\# Head\n\n\\---\n\nline #⁠1 \\& more\n\n<!-- posting:id=li:big-corp:a-%2Db%20c -->\n"
)
