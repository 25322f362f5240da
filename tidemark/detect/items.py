"""Current-report items: auditor changes, non-reliance, officers who leave; late notices; review letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import FLAGS, collapse, first_positions, let, mask, sentences


def non_reliance_limb(text: Column) -> Column:
    """a where management or the board concluded, b where the auditor advised; an explicit reference first; else null."""
    explicit = F.lower(F.regexp_extract(text, r"(?i)Item\s*4\.02\s*\(\s*([ab])\s*\)", 1))
    told = text.rlike(FLAGS + r"\badvised\s+by\s+(?:its|the|our)\s+(?:\w+\s+){0,4}account\w*|\b(?:accounting\s+firm|auditors?)\s+(?:has\s+|have\s+)?(?:advised|notified|informed)\b")
    concluded = text.rlike(FLAGS + r"\b(?:board|audit\s+committee|management|chief\s+financial\s+officer)\b[^.]{0,120}?\b(?:concluded|determined|identified)\b")
    return F.when(explicit != "", explicit).when(told, "b").when(concluded, "a")


_FIRM = r"(?:accounting\s+firm|accountants?|auditors?)"


def auditor_direction(text: Column) -> Column:
    """How the engagement ended: withdrawn before resigned before declined before dismissed; null where the text tells of no auditor's end."""
    near = lambda verbs: text.rlike(FLAGS + rf"\b(?:{verbs})\b[^.]{{0,160}}?\b{_FIRM}\b|\b{_FIRM}\b[^.]{{0,160}}?\b(?:{verbs})\b")
    return F.when(near("withdr[ae]w|withdrawn"), "withdrawn").when(near("resign(?:ed|s|ation)?"), "resigned").when(near("declined\\s+to\\s+stand"), "declined").when(near("dismiss(?:ed|al)?|terminat(?:ed|ion)"), "dismissed")


def disagreements(text: Column) -> Column:
    """True where a disagreement is told, false where there was expressly none, null where the text is silent."""
    none = FLAGS + r"\b(?:no|not\s+any|without(?:\s+any)?)\s+(?:\(\w+\)\s*)?(?:\w+\s+){0,2}?disagreements?\b|\bnot\s+the\s+result\s+of\s+any\s+(?:disagreement|dispute|quarrel)"
    told = mask(text, none).rlike(FLAGS + r"\bdisagreements?\b")
    return F.when(told, True).when(text.rlike(none), False)


_ROLE = r"(?:chief\s+(?:financial|accounting)\s+officer|principal\s+(?:financial|accounting)\s+officer|finance\s+head|controller|treasurer|CFO)"
_LEAVES = r"(?:resign(?:s|ed|ation)?|retire[sd]?|retirement|depart(?:s|ed|ure)?|step(?:s|ped)?\s+down|terminated|will\s+leave|left|cease[sd]?\s+to\s+serve|separat(?:ed|ion))"


def officer_departure(text: Column) -> Column:
    """Whether some one sentence names a finance role and a leaving."""
    return F.exists(sentences(text), lambda s: s.rlike(FLAGS + rf"\b{_ROLE}\b") & s.rlike(FLAGS + rf"\b{_LEAVES}\b"))


def successor_named(text: Column) -> Column:
    """False where a successor is denied or only an interim one named, true where one is appointed, null where the text is silent."""
    denied = text.rlike(FLAGS + r"\b(?:not\s+(?:yet\s+)?(?:named|appointed|identified)|no)\s+(?:a\s+|any\s+)?(?:permanent\s+)?successor\b|\bsearch\s+for\s+(?:a|his|her|their)\s+(?:successor|replacement)\b")
    interim = text.rlike(FLAGS + r"\b(?:interim|acting)\b|\bfor\s+the\s+time\s+being\b")
    named = text.rlike(FLAGS + r"\b(?:appoint(?:s|ed)|named|elected|promoted|will\s+succeed|succeeds)\b")
    return F.when(denied | (interim & named), False).when(named, True)


def officer_severity(text: Column) -> Column:
    quarrel = F.coalesce(disagreements(text), F.lit(False))
    return F.when(~F.coalesce(officer_departure(text), F.lit(False)), None).when(quarrel, "high").when(F.coalesce(~successor_named(text), F.lit(False)), "high").otherwise("normal")


_BOX_ON, _BOX_OFF = r"(?:[☒☑]|\[\s*[xX]\s*\])", r"(?:☐|\[\s*\])"


def ticked(text: Column, question: str) -> Column:
    """The answer ticked behind a question: boxes before or after their labels; null where both or neither is ticked."""
    tail = F.regexp_extract(text, rf"(?is){question}(.{{0,400}})", 1)
    labels_first = tail.rlike(r"(?is)^[^\w☐☒☑\[]*(?:yes|no)\b")
    on = lambda word: F.when(labels_first, tail.rlike(rf"(?is)\b{word}\s*{_BOX_ON}")).otherwise(tail.rlike(rf"(?is){_BOX_ON}\s*{word}\b"))
    return F.when(on("yes") & ~on("no"), True).when(on("no") & ~on("yes"), False)


def period_on_form(text: Column) -> Column:
    """The period a notice states, in any of three ways to write a date; null for none or an impossible one."""
    tail = F.regexp_extract(text, r"(?is)period\s+ended:?\s*(.{0,40})", 1)
    grab = lambda p: F.nullif(F.regexp_extract(tail, p, 1), F.lit(""))
    return F.coalesce(
        F.try_to_date(F.initcap(F.regexp_replace(grab(r"(?i)^\s*([a-z]+\s+\d{1,2},?\s+\d{4})"), r"[,\s]+", " ")), "MMMM d yyyy"), F.try_to_date(grab(r"^\s*(\d{1,2}/\d{1,2}/\d{4})"), "M/d/yyyy"), F.try_to_date(grab(r"^\s*(\d{4}-\d{2}-\d{2})"), "yyyy-MM-dd")
    )


_BOILERPLATE = FLAGS + r"without\s+unreasonable\s+effort|rule\s+12b-25|check\s+(?:box|appropriate)|state\s+below\s+in\s+reasonable\s+detail"


def late_reason(text: Column, longest: int = 700) -> Column:
    """What the notice's narrative says of itself: Part III to Part IV without the form's own words, whole sentences of some length."""
    part = F.regexp_extract(text, r"(?is)part\s+iii\b(.{0,4000}?)(?:part\s+iv\b|$)", 1)
    clean = collapse(F.regexp_replace(part, rf"(?is){_BOX_ON}|{_BOX_OFF}|\([a-d]\)|\bnarrative\b", " "))
    kept = F.filter(F.split(clean, r"(?<=[.!?])\s+(?=\p{Lu})"), lambda s: (F.length(s) > 45) & ~s.rlike(_BOILERPLATE))
    return F.substring(F.array_join(kept, " "), 1, longest)


#: What makes a late notice more than routine.
_SUBSTANTIVE = FLAGS + (
    r"\brestat\w+|\berror(?:s)?\b|material\s+weakness|significant\s+deficienc|non-?reliance|resign\w+|dismiss\w+|terminat\w+|internal\s+(?:review|investigation)|independent\s+(?:review|investigation)"
    r"|audit\s+committee\s+(?:review|investigation)|forensic|bankrupt\w+|chapter\s+(?:7|11)|delist\w+|going\s+concern|revenue\s+recognition|impairment|fraud|misstat\w+|departure|chief\s+(?:executive|financial)"
)


def late_severity(reason: Column, days_late: Column, change_expected: Column, others_filed: Column, annual: Column) -> Column:
    """What the notice says comes first, then how late the report is."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(reason.rlike(_SUBSTANTIVE)) | yes(days_late >= 90), "high").when(yes(days_late >= 30) | yes(change_expected) | yes(~others_filed) | yes(annual), "elevated").otherwise("normal")
    )


def subject_line(text: Column) -> Column:
    return collapse(F.regexp_extract(text, r"(?s)\bRe:\s*(.{0,220})", 1))


def reviews_a_periodic_report(subject: Column) -> Column:
    """Whether a letter's subject is a periodic report, not only a registration."""
    return F.coalesce(subject.rlike(FLAGS + r"\bForms?\s+(?:10-KT?|10-QT?|20-F|40-F)\b"), F.lit(False))


#: What review letters ask about.
TOPICS = {
    "Revenue recognition": r"\brevenue\s+recognition\b|\bASC\s*606\b|\bTopic\s*606\b|\bperformance\s+obligation",
    "Non-GAAP measures": r"\bnon-?GAAP\b|\badjusted\s+EBITDA\b|\bRegulation\s+G\b|\bItem\s+10\(e\)",
    "Segment reporting": r"\bsegment\s+(?:report|disclosur|informat)|\bASC\s*280\b|\breportable\s+segment|\bchief\s+operating\s+decision\s+maker\b",
    "Goodwill and impairment": r"\bgoodwill\b|\bimpairment\b|\bASC\s*350\b|\bASC\s*360\b",
    "Business combinations": r"\bbusiness\s+combination|\bASC\s*805\b|\bpurchase\s+price\s+allocation\b|\breverse\s+(?:merger|recapitali)",
    "Internal control": r"\bmaterial\s+weakness\b|\binternal\s+control\s+over\s+financial\s+reporting\b|\bICFR\b|\bdisclosure\s+controls\b|\bItem\s+9A\b",
    "Going concern": r"\bgoing\s+concern\b|\bASC\s*205-40\b",
    "Income taxes": r"\bincome\s+tax|\bvaluation\s+allowance\b|\bASC\s*740\b",
    "Fair value": r"\bfair\s+value\b|\bASC\s*820\b|\bLevel\s+3\b",
    "Leases": r"\bleases?\b|\blessee\b|\blessor\b|\bASC\s*842\b",
    "Share-based compensation": r"\bshare-?based\s+compensation\b|\bstock-?based\s+compensation\b|\bASC\s*718\b",
    "Crypto assets": r"\bcrypto\s*(?:currenc|asset)|\bdigital\s+asset|\bbitcoin\b",
    "Inventory": r"\binventor(?:y|ies)\b|\bASC\s*330\b",
    "MD&A": r"\bManagement'?s?\s+Discussion\s+and\s+Analysis\b|\bMD&A\b|\bresults\s+of\s+operations\b",
}


def topics(text: Column) -> Column:
    return first_positions(text, {n: FLAGS + p for n, p in TOPICS.items()})


#: Fixed value: a place in a report that a letter points to.
_CITED = FLAGS + r"(Note\s+\d+[^,;]{0,80}|Item\s+\d+[A-Z]?\.?[^,;]{0,60})\s*,?\s*page\s+(\d+)"


def citations(text: Column, most: int = 4) -> Column:
    """The first few notes and items that are cited with a page, each once whatever its page and case."""
    labels, pages = (F.regexp_extract_all(text, F.lit(_CITED), F.lit(k)) for k in (1, 2))
    pairs = F.zip_with(F.transform(labels, collapse), pages, lambda label, page: F.struct(label.alias("label"), page.alias("page")))
    own = lambda all_: F.filter(all_, lambda p, i: (F.length(p["label"]) >= 4) & (F.array_position(F.transform(all_, lambda q: F.lower(q["label"])), F.lower(p["label"])) == i + 1))
    return F.slice(F.transform(let(pairs, own), lambda p: F.concat(p["label"], F.lit(", page "), p["page"])), 1, most)


def blank_check(company: Column, sic: Column, text: Column) -> Column:
    """A shell that is to combine with a business: by industry, by its wording, or by a name and a trust."""
    words = text.rlike(FLAGS + r"\b(?:initial\s+business\s+combination|combination\s+period)\b")
    named = company.rlike(FLAGS + r"\bacquisition\b") & text.rlike(FLAGS + r"\btrust\s+account\b")
    return F.coalesce(sic == 6770, F.lit(False)) | F.coalesce(words, F.lit(False)) | F.coalesce(named, F.lit(False))


def business_replaced(renamed: Column, current: Column, prior: Column) -> Column:
    """A rename together with a reverse acquisition that the report before did not tell of."""
    told = lambda c: F.coalesce(c.rlike(FLAGS + r"\breverse\s+(?:acquisition|merger|recapitali[sz]ation)\b"), F.lit(False))
    return renamed & told(current) & ~told(prior)


def tier_downgrade(before: Column, after: Column) -> Column:
    """Whether a firm of a lower tier follows; null where either is unknown."""
    rank = lambda t: F.when(t == "big_four", 3).when(t == "national", 2).when(t == "other", 1)
    return rank(after) < rank(before)


def auditor_severity(direction: Column, quarrel: Column, downgrade: Column) -> Column:
    """high for a resignation, a withdrawal, a disagreement or a fall in tier; elevated for a refusal to stand again; else normal."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(direction.isin("resigned", "withdrawn") | yes(quarrel) | yes(downgrade), "high").when(direction == "declined", "elevated").otherwise("normal")


def only_the_letter(explanation: Column) -> Column:
    """An amendment that merely files the former accountant's letter or a signature adds nothing to what it amends."""
    letter = explanation.rlike(FLAGS + r"\b(?:solely|only)\b[^.]{0,160}?\b(?:exhibit\s+16(?:\.1)?|letter\s+from)\b|\bsole\s+purpose\b[^.]{0,160}?\b(?:exhibit\s+16(?:\.1)?|letter)\b")
    signature = explanation.rlike(FLAGS + r"\b(?:solely|only|sole\s+purpose)\b[^.]{0,160}?\bsignature\b")
    return F.coalesce(letter | signature, F.lit(False))


def admits_letter(body: Column, staff: Column) -> Column:
    """Long enough, and a staff letter comments or a company's letter answers."""
    comments = body.rlike(FLAGS + r"\b(?:we\s+have\s+(?:reviewed|the\s+following\s+comments?)|please\s+(?:tell|explain|revise|clarify)|our\s+comments?)\b")
    answers = body.rlike(FLAGS + r"\b(?:in\s+response\s+to|respond(?:s|ed)?\s+(?:as\s+follows|to)|response:)\b")
    return F.coalesce((F.length(body) >= 400) & F.when(staff, comments).otherwise(answers), F.lit(False))


def first_comment(body: Column, longest: int = 420) -> Column:
    """The first question of a letter: what follows the salutation and the customary opening, to a word before the limit."""
    from tidemark.functions.text import close_quote, truncate_words

    after = F.regexp_replace(body, r"(?is)^.*?\bdear\b[^:\n]{0,80}:\s*", "")
    plain = collapse(F.regexp_replace(after, r"(?i)\bpage\s+\d+\b|(?:^|(?<=[.?!]\s))\d{1,2}\.\s+(?=[A-Z])", " "))
    own = F.filter(F.split(plain, r"(?<=[.?!])\s+(?=\p{Lu})"), lambda s: ~s.rlike(FLAGS + r"^we\s+have\s+reviewed|^please\s+respond\b|^after\s+reviewing|^if\s+you\s+do\s+not\s+believe|\bten\s+business\s+days\b|^sincerely") & (F.length(s) >= 30))
    return close_quote(truncate_words(F.array_join(own, " "), longest))


#: What the item codes are called.
ITEM_TITLES = {"4.01": "Change of certifying accountant", "4.02": "Earlier statements not to be relied on", "5.02": "Departure of officers"}


def item_events(filings):
    """One event for each filing and signal that its item codes name: (seq, id, signal_type, item_code, item_title, confidence, headline).

    ``filings`` is the day index with ``seq``; a filing listed twice gives its events once, from the first listing.
    """
    from tidemark import schema
    from tidemark.functions.scalars import event_id

    code = F.trim("code")
    named = F.when(F.lit(False), "")
    title = F.when(F.lit(False), "")
    for c, s in schema.ITEM_SIGNALS.items():
        named, title = named.when(code == c, s), title.when(code == c, ITEM_TITLES[c])
    one = filings.filter(F.upper(F.trim("form")).isin(*schema.EVENT_FORMS)).select("seq", "accession", "company", F.explode(F.array_distinct(F.transform("items", lambda i: F.trim(i)))).alias("code"))
    found = one.select("seq", "accession", "company", code.alias("item_code"), named.alias("signal_type"), title.alias("item_title")).filter("signal_type is not null and accession is not null")
    first = found.groupBy("accession", "signal_type").agg(F.min(F.struct("seq", "item_code", "item_title", "company")).alias("f"))
    return first.select(F.col("f.seq").alias("seq"), event_id(F.col("accession"), F.col("signal_type")).alias("id"), "signal_type", F.col("f.item_code").alias("item_code"), F.col("f.item_title").alias("item_title"), F.lit("confirmed").alias("confidence"))
