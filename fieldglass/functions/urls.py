"""URLs: normal form, parts, scheme, domain and path policies, links of a page. JVM-side but for relative links."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def host(url: Column) -> Column:
    """Host in lower case without port and one leading www."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r":\d+$", ""), r"^www\.", "")


def normal_form(url: Column) -> Column:
    """Lower-case scheme and host, no default port, query pairs sorted and those without value dropped, no fragment; null for what is no URL."""
    u = F.trim(url)
    scheme, authority = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)), F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    authority = F.when(scheme == "http", F.regexp_replace(authority, r":80$", "")).when(scheme == "https", F.regexp_replace(authority, r":443$", "")).otherwise(authority)
    path, query = F.regexp_extract(u, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.+$"))), "&")
    return F.when((scheme != "") & (authority != ""), F.concat(scheme, F.lit("://"), authority, F.when(path == "", "/").otherwise(path), F.when(pairs != "", F.concat(F.lit("?"), pairs)).otherwise("")))


def parameter(url: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def fetchable_scheme(url: Column) -> Column:
    """http, https or relative; protocol-relative URLs are not."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    return F.coalesce(~url.startswith("//") & scheme.isin("http", "https", ""), F.lit(False))


def same_domain(url: Column, domain: str) -> Column:
    return F.coalesce(host(url) == domain.lower().removeprefix("www."), F.lit(False))


def restricted(url: Column, extensions: list[str], prefixes: list[str], names: list[str]) -> Column:
    """By the lower-case path alone: its extension, its beginning or its last name is listed."""
    path = F.lower(F.regexp_extract(url, r"^(?:[^:/?#]+://[^/?#]*)?([^?#]*)", 1))
    last = F.regexp_extract(path, r"([^/]*)$", 1)
    hit = F.regexp_extract(last, r"\.([a-z0-9]+)$", 1).isin(*extensions) | last.isin(*names)
    for p in prefixes:
        hit = hit | path.startswith(p)
    return F.coalesce(hit, F.lit(False))


def first_rule(url: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first (pattern, label) whose pattern is found in the URL, in lower case."""
    out = None
    for pattern, label in rules:
        hit = F.lower(url).rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def fan_out(bases: list[str], filters: list[str]) -> Column:
    """Every base with every filter, as an array to explode."""
    return F.array(*[F.lit(b + f) for b in bases for f in filters])


@F.pandas_udf(T.StringType())
def resolve(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link as an absolute URL; null if either is null or malformed."""

    def one(b, x):  # noqa: ANN001, ANN202
        try:
            return None if b is None or x is None else urljoin(b, x)
        except ValueError:
            return None

    return pd.Series([one(b, x) for b, x in zip(base, link, strict=True)])


# Words in the path (p) or whole URL (u), in lower case, and the family they tell; the first that is found counts.
FAMILIES_A = [
    ("p", "members register login payment subscription", "restricted"), ("p", "faq", "faq"), ("p", "privacy cookie terms legal about contact", "legal"), ("u", "run_in runin", "run_in"), ("u", "relative_form relativeform", "relative_form"), ("u", "projected", "projected_points"),
    ("u", "performance", "performance_rating"), ("u", "home_advantage homeadvantage", "home_advantage"), ("u", "streaks", "current_streaks"), ("u", "over_under overunder", "over_under"), ("u", "total_goals totalgoals", "total_goals"), ("u", "goal_ranges goalranges", "goal_ranges"),
    ("u", "average_goals averagegoals", "average_goals"), ("u", "scored_conceded scoredconceded", "scored_conceded"), ("u", "both_teams_scored btts", "both_teams_scored"), ("u", "goal_margins goalmargins", "goal_margins"), ("u", "10_minutes 10min", "goals_by_10_minutes"),
    ("u", "15_minutes 15min", "goals_by_15_minutes"), ("u", "timing", "goal_timing"), ("u", "first_goal firstgoal", "first_goal"), ("u", "both_halves bothhalves", "scored_both_halves"), ("u", "lead_durations leaddurations", "lead_durations"),
    ("u", "leading_trailing leadingtrailing", "leading_trailing"), ("u", "goal_types goaltypes", "goal_types"), ("u", "equaliser", "equalisers"), ("u", "statistics_by_date bydate", "statistics_by_date"), ("p", "pmatch.asp", "match_preview"), ("p", "round_details.asp", "round_details"),
    ("p", "results.asp", "results"), ("p", "matchlist.asp", "match_list"), ("p", "matches.asp", "matches"), ("p", "latest.asp", "league_latest"), ("p", "leagueview_team.asp", "leagueview_team"), ("p", "leagueview.asp", "league_view"), ("p", "homeaway.asp", "home_away"),
    ("p", "formtable.asp", "form_table"), ("p", "widetable.asp", "wide_table"), ("p", "statsbymonth.asp", "stats_by_month"), ("p", "trends.asp", "trends"), ("p", "table.asp", "generic_table"), ("p", "teamstats.asp", "team_stats"), ("p", "stats.asp", "statistical_overview"), ("p", "leagues.asp", "matches"),
]
HOME_PAGES = ("/", "", "/index.asp", "/index.html", "/default.asp")
FAMILIES_B = [
    ("value odds bookmaker", "values_or_odds"), ("/tennis /basketball /hockey /rugby /cricket /volleyball /handball /esports", "non_soccer"), ("privacy terms cookie contact about faq", "site_information"), ("football-tips-and-predictions-for-today", "daily_predictions"),
    ("football-tips-and-predictions-for-tomorrow", "tomorrow_predictions"), ("weekend", "weekend_predictions"), ("yesterday finished predictions-from", "finished_predictions"), ("livescore", "livescore"), ("live-football-tips", "live_predictions"), ("football-match-previews", "match_preview_index"),
    ("/football/matches/", "football_match"), ("/teams/", "team_page"), ("injured-players", "injured_players"), ("team-comparison", "team_comparison"), ("/trends/top /top-trends", "top_trends"), ("/trends", "trends"), ("half-time-full-time ht-ft htft", "half_time_full_time"),
    ("over-under over_under goal-", "goals_market"), ("half-time /ht/", "half_time"), ("both-teams btts both_teams", "btts"), ("double-chance double_chance", "double_chance"), ("handicap", "asian_handicap"), ("scorer", "goalscorers"), ("corner", "corners"), ("/card yellow-card red-card", "cards"),
    ("1x2 /result-", "result_market"),
]
#: What is never fetched.
BLOCKED_EXTENSIONS = "jpg jpeg png gif svg webp ico woff woff2 ttf eot otf css js json xml pdf zip mp4 mp3 avi mov".split()
BLOCKED_PREFIXES = "/cdn-cgi/ /js/ /css/ /images/ /img/ /flags/ /logos/ /ads/ /advert/".split()
BLOCKED_NAMES = "members.asp register.asp login.asp signup.asp payment.asp subscription.asp error.htm error.html error.asp".split()
#: What an index page shows by its number.
SCOPES = {"0": "results", "1": "home_away", "2": "home_away", "6": "by_time_home_away", "100": "results_all_games", "101": "all_games", "102": "all_games", "106": "by_time_all_games", "200": "results_last_8", "201": "last_8", "202": "last_8", "206": "by_time_last_8"}


def path_of(url: Column) -> Column:
    """The path in lower case."""
    return F.lower(F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1))


def _any(c: Column, words: str) -> Column:
    return c.rlike("|".join(re.escape(w) for w in words.split()))


def family_a(url: Column) -> Column:
    """The family of a page of the first source; `unknown` if no rule fits, null for null."""
    path, out = path_of(url), None
    for where, found, family in FAMILIES_A:
        hit = _any(path if where == "p" else F.lower(url), found)
        out = F.when(hit, family) if out is None else out.when(hit, family)
    return F.when(url.isNotNull(), out.when(path.isin(*HOME_PAGES), "homepage").otherwise("unknown"))


def family_b(url: Column) -> Column:
    """The family of a page of the second source: words in the path, then what stands after `football-predictions`."""
    path, out = path_of(url), None
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    last = F.element_at(parts, -1)
    for found, family in FAMILIES_B:
        hit = _any(path, found)
        if family == "match_preview_index":  # an article's name begins with its number
            article = hit & (last != found) & F.split_part(last, F.lit("-"), F.lit(1)).rlike(r"\d")
            out = out.when(article, "match_preview_article")
        out = F.when(hit, family) if out is None else out.when(hit, family)
    after = F.size(parts) - F.array_position(parts, F.lit("football-predictions")).cast("int")
    inside = F.array_contains(parts, "football-predictions") & (F.size(parts) >= 3)
    out = out.when(path.contains("top") & path.contains("predict"), "top_predictions").when(inside & (after >= 2), "competition_page").when(inside & (after == 1), "country_page")
    return F.when(url.isNotNull(), out.when(_any(path, "football-predictions football-tips prediction-list"), "prediction_list").otherwise("unknown"))


def blocked(url: Column) -> Column:
    """True for what must never be fetched: another scheme, or a path of a listed kind."""
    return ~fetchable_scheme(url) | restricted(url, BLOCKED_EXTENSIONS, BLOCKED_PREFIXES, BLOCKED_NAMES)


def allowed(url: Column, domain: str) -> Column:
    """The whole gate: scheme, domain and not blocked."""
    return fetchable_scheme(url) & same_domain(url, domain) & ~blocked(url)


def outcome(url: Column, domain: str, family: Column) -> Column:
    """Struct (category, family): restricted, external, or what the family says; known for the rest."""
    named = F.when(family.isin("unknown", "restricted", "values_or_odds", "non_soccer"), family).otherwise("known")
    category = F.when(blocked(url), "restricted").when(~same_domain(url, domain), "external").otherwise(named)
    return F.struct(category.alias("category"), F.when(category == "known", family).otherwise(category).alias("family"))


def scope_label(url: Column) -> Column:
    """What an index page shows, by its `matchday`, `unknown_<n>` for others; with `_expanded_<ms>` if `ms` is given."""
    day, ms = F.coalesce(parameter(url, "matchday"), F.lit("")), parameter(url, "ms")
    base = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SCOPES.items() for x in kv]), day), F.concat(F.lit("unknown_"), day))
    return F.concat(base, F.coalesce(F.concat(F.lit("_expanded_"), ms), F.lit("")))


def market_urls(base: str, day: Column, wanted: list[str], known: list[str]) -> Column:
    """Array of (market, url) for the wanted markets that are known, in the order wanted."""
    return F.array(*[F.struct(F.lit(m).alias("market"), F.concat(F.lit(f"{base}?ln=en&tp={m}&in="), day, F.lit("&ord=0&tz=0&tzs=&tze=")).alias("url")) for m in wanted if m in known])


def seeds(defaults: dict[str, list[str]], source: str, overrides: list[str] | None = None) -> list[str]:
    """The overrides if there are any, else the source's defaults; an unknown source has none."""
    return list(overrides or defaults.get(source, []))


def directory(links: Column, name: str) -> Column:
    """The distinct values, sorted, that a page's links give a query parameter."""
    pattern = rf"[?&]{re.escape(name)}=([^&#]+)"
    return F.array_sort(F.array_distinct(F.filter(F.transform(links, lambda u: F.regexp_extract(u, pattern, 1)), lambda x: x != "")))
