"""Made-up people, phrases and pages; what a test expects follows from how a sample is built."""

import datetime as dt
import itertools
import json
import random

BASE = "https://site.example"
PAD = " " * 100
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December"]


def word(rng, syllables=3):
    return "".join(rng.choices(["ba", "ru", "ti", "lo", "ke", "mi", "zo", "wen", "dar"], k=syllables)).capitalize()


def some_date(rng):
    return dt.date(1900, 1, 1) + dt.timedelta(days=rng.randrange(73_000))


def month_forms(month):
    name = MONTHS[month - 1]
    return [name] if name == "May" else [name, name[:3], name[:3] + "."]


def ordinal(day):
    return "th" if 10 <= day % 100 <= 20 else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


def written(rng, date, weekday=False):
    """A date in one of the long forms."""
    day = f"{date.day}{ordinal(date.day) if rng.random() < .4 else ''}{rng.choice([',', ''])}"
    lead = date.strftime("%A") + rng.choice([", ", " "]) if weekday else ""
    return f"{lead}{rng.choice(month_forms(date.month))} {day} {date.year}"


# What the date patterns look for, by label. {w} is any word, {W} some words.
DEATH_LEADS = {
    "a": ["passed away ", "passed away on ", "passed away {w} ", "passed away {w} {w} on "],
    "b": [f"passed {x} {y}" for x in ("peacefully", "quietly", "suddenly", "unexpectedly") for y in ("", "on ")],
    "c": ["passed on ", "passed on to {w} {w} {w} ", "passed on to {w} {w} {w} on "],
    "d": ["passed from {W} ", "passed from {W} on "],
    "e": ["went to be with {W} ", "went home to be with {W} on "],
    "f": ["entered rest ", "entered eternal rest ", "entered into rest on "],
    "g": ["died ", "died on "],
    "h": ["death ", "death on "],
    "i": ["- ", "– ", "—"],
}
BIRTH_LEADS = {"l": ["born to {W} and {W} on ", "born "], "m": ["born on ", "born in "]}
WITHOUT_WEEKDAY = {"h", "i", "l", "m"}


def dated_texts(leads, seed):
    """(text, date, label) for every phrase, with and without a weekday."""
    rng = random.Random(seed)
    out = []
    for label, forms in leads.items():
        for form, weekday in itertools.product(forms, {False, label not in WITHOUT_WEEKDAY}):
            date = some_date(rng)
            lead = form
            while "{" in lead:
                lead = lead.replace("{w}", word(rng).lower(), 1).replace("{W}", f"{word(rng)} {word(rng)}", 1)
            case = rng.choice([str, str.upper, str.capitalize])
            text = f"{word(rng)} {case(lead)}{written(rng, date, weekday)}{rng.choice(['.', ' at ' + word(rng), '', ', ' + word(rng)])}"
            out.append((text, date.isoformat(), label))
    return out


def slashed_texts(seed):
    rng = random.Random(seed)
    out = []
    for lead, label in (("passed away ", "j"), ("passed away {} ", "j"), ("died ", "k"), ("died on ", "k"), ("born ", "n"), ("born on ", "n")):
        d = some_date(rng)
        out.append((f"{word(rng)} {lead.format(word(rng).lower())}{d.month}/{d.day:02}/{d.year}", d.isoformat(), label))
    return out


# --- people and pages ---------------------------------------------------------------------

#: Fields that a listing item may lack; each is left out or null.
OPTIONAL = ["middleName", "suffix", "fullName", "funeralHome", "obitSnippet", "links", "datePostedFrom", "location"]


def listing_people(count, seed):
    """(item, expected record) pairs over many subsets of missing fields."""
    rng = random.Random(seed)
    out = []
    for n in range(count):
        first, middle, last, home, city = (word(rng) for _ in range(5))
        posted, died = some_date(rng), some_date(rng)
        path = f"/us/obituaries/name/{last.lower()}?id={n}"
        full = f'{first} "{word(rng, 1)}" {last}'
        text = f"{first} died {written(rng, died)}."
        fields = {"middleName": middle, "suffix": rng.choice(["Jr.", "III", "Sr."]), "fullName": full,
                  "funeralHome": {"id": n, "name": home}, "obitSnippet": text,
                  "links": {"obituaryUrl": {"href": rng.choice([BASE, ""]) + path, "path": "/unused"}},
                  "datePostedFrom": f"{posted}T00:00:00", "location": {"city": {"fullName": city}, "state": {"code": "TX"}}}
        gone = set(rng.sample(OPTIONAL, rng.randint(0, len(OPTIONAL)))) if n else set()
        have = {k: v for k, v in fields.items() if k not in gone}
        have |= {k: None for k in gone if rng.random() < .5}
        name = {"firstName": first, "lastName": last, "nickName": "unused",
                **{k: have[k] for k in ("middleName", "suffix", "fullName") if k in have}}
        item = {"personId": n, "name": name, "publisherName": "Gazette",
                **{k: v for k, v in have.items() if k not in ("middleName", "suffix", "fullName")}}
        has = lambda k: have.get(k) is not None
        out.append((item, {
            "url": BASE + path if has("links") else "", "deceased_name": full if has("fullName") else f"{first} {last}",
            "first_name": first, "middle_name": middle if has("middleName") else "", "last_name": last,
            "name_suffix": fields["suffix"] if has("suffix") else "", "obit_text": text if has("obitSnippet") else "",
            "published_date": posted if has("datePostedFrom") else None, "death_date": died if has("obitSnippet") else None,
            "birth_date": None, "funeral_home": home if has("funeralHome") else "Gazette",
            "city": city if has("location") else "", "state": "TX" if has("location") else ""}))
    return out


def state_people(count, seed):
    """(edge, expected values) of the older layout; a missing first name leaves one word."""
    rng = random.Random(seed)
    out = []
    for n in range(count):
        first, last, suffix = (None if n % 3 == 1 else word(rng)), word(rng), rng.choice(["", "", "Jr.", "IV"])
        suffix = suffix if first else ""
        full = " ".join(x for x in (first, last, suffix) if x)
        posted, died, linked = some_date(rng), some_date(rng), n % 4 != 2
        node = {"name": {"firstName": first, "lastName": f"{last} {suffix}".strip()}, "obituaryNoHtml": f"about {last}",
                "publishedDate": f"{posted:%B} {posted.day}, {posted.year}", "deathDate": died.isoformat(),
                "funeralHomeName": word(rng), "links": {"obituaryUrl": {"path": f"/p{n}"}} if linked else None}
        out.append(({"node": node}, {
            "url": f"{BASE}/p{n}" if linked else "", "deceased_name": full, "first_name": first or last,
            "last_name": last if first else "", "name_suffix": suffix, "obit_text": f"about {last}",
            "published_date": posted, "death_date": died, "birth_date": None, "funeral_home": node["funeralHomeName"], "city": ""}))
    return out


def link_people(count, seed):
    """(html, expected (url, name)) of plain links; the name is the texts without the white
    space around each."""
    rng = random.Random(seed)
    out = []
    for n in range(count):
        parts = [word(rng) for _ in range(rng.randint(1, 3))]
        inner = f" {parts[0]} " + "".join(f"<{t}>{p}</{t}> " for p, t in zip(parts[1:], itertools.cycle("bi")))
        url = f"/us/obituaries/name/{parts[0].lower()}?id={n}"
        headed = n % 2 == 0
        html = f'<a href="{url}">' + (f"<h3>{inner}</h3><p>{word(rng)}</p>" if headed else inner) + "</a>"
        out.append((html, (BASE + url, "".join(parts))))
    return out


def script(payload, kind="application/json"):
    return f'<html><script type="{kind}"><!--{payload}--></script></html>'


def listing(items, key="obituaryList", **extra):
    return script(json.dumps({"adMap": {"pad": PAD}, **extra, key: {"obituaries": items}}))


def state_page(edges, indent=None):
    data = {"BrowseStore": {"data": {"obituaries": {"obituaries": {"edges": edges}}}}}
    return f"<script>window.__INITIAL_STATE__ = {json.dumps(data, indent=indent)}\n;</script>"


def detail_sample(seed):
    """A detail page and its fields."""
    rng = random.Random(seed)
    first, last, home, view = (word(rng) for _ in range(4))
    born, died = some_date(rng), some_date(rng)
    page = (f'<html><body><h1 class="top">{word(rng)}</h1><h1 data-testid="obit-name">{first} <b>{last}</b> </h1>'
            f'<div data-testid="obit-dates">{born:%B} {born.day}, {born.year} - {died:%b} {died.day}, {died.year}</div>'
            f'<div class="fh-name">{word(rng)}</div><a href="/funeral-home/{seed}">{home} <i>{view}</i></a>'
            f'<article>whole</article><div class="big obituary-body"><p>{first} <b>{home}</b> left.</p><!-- c -->'
            f'<div>{view}&nbsp;&amp; kept</div><script>no()</script><style>no</style><p>{last}</div>after</body></html>')
    return page, {"name": first + last, "text": f"{first} {home} left. {view}\xa0& kept {last}", "funeral_home": home + view,
                  "published": None, "death": died}
