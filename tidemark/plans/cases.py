"""Literal cases for the text readers: what goes in, what must come out. The SQL side is the expected table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.detect import conclusions, items, spans
from tidemark.functions import scalars, text
from tidemark.operators import firms
from tidemark.plans.registry import query


def _sql(v) -> str:
    return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'"


def _cases(name: str, cases: list[tuple[str, object]], of, kind: str = "string"):
    sql_type = {"string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}[kind]
    rows = ", ".join(f"({i}, CAST({_sql(want)} AS {sql_type}))" for i, (_, want) in enumerate(cases))

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "n int, t string")
        got: Column = of(F.col("t"))
        return df.select("n", got.cast(kind).alias("got"))

    run.__name__ = name
    query(f'SELECT n, got FROM (VALUES {rows}) v(n, got)')(run)


GOING_CONCERN = [
    ("Management concluded that substantial doubt about our ability to go on is not raised.", "none"),
    ("These matters do not raise substantial doubt about the Company.", "none"),
    ("There was no substantial doubt at year end.", "none"),
    ("We judged that substantial doubt does not exist.", "none"),
    ("The conditions above raise substantial doubt about our ability to continue.", "substantial_doubt"),
    ("Management concluded that substantial doubt exists about the entity.", "substantial_doubt"),
    ("Plans were made, but the substantial doubt has not been alleviated.", "substantial_doubt"),
    ("We made plans to alleviate the conditions that raise substantial doubt. We concluded that substantial doubt exists.", "substantial_doubt"),
    ("The losses raised substantial doubt. Our plans alleviate the substantial doubt.", "doubt_alleviated"),
    ("We looked at whether the going concern basis is apt.", "none"),
    ("No conditions or events, taken together, raise substantial doubt.", "none"),
    ("No conditions or events raise substantial doubt. The covenant breach raises substantial doubt.", "substantial_doubt"),
    ("A failed refinancing may raise substantial doubt.", "none"),
    ("A failed refinancing may raise substantial doubt. Present losses raise substantial doubt.", "substantial_doubt"),
    ("The losses raise substantial doubt. There is no assurance that the plans will alleviate the substantial doubt.", "substantial_doubt"),
    ("The losses raised substantial doubt. The completed loan has alleviated the substantial doubt.", "doubt_alleviated"),
    ("In spite of this, substantial doubt about the Company remains.", "substantial_doubt"),
    ("After the sale substantial doubt no longer remains.", "none"),
    ("The plans do not alleviate the substantial doubt.", "substantial_doubt"),
    ("The plans do not alleviate the substantial doubt. A later loan alleviates the substantial doubt.", "doubt_alleviated"),
    ("", "none"),
    (None, None),
]
_cases("going_concern_cases", GOING_CONCERN, conclusions.going_concern)
_cases("going_concern_quote_cases", [("Cash is low. These losses raise substantial doubt about us. We sell soap.", "These losses raise substantial doubt about us."), ("We sell soap.", None)], conclusions.going_concern_quote)
_cases("going_concern_headline_cases", [("none>substantial_doubt", "Soap Inc now reports substantial doubt"), ("substantial_doubt>none", "Soap Inc went from substantial doubt to no doubt")], lambda t: conclusions.going_concern_headline(F.lit("Soap Inc"), F.split(t, ">")[0], F.split(t, ">")[1]))
_cases("standards_told_cases", [("We have adopted ASU 2023-08 on January 1, 2024. The FASB issued ASU 2024-03 in November.", "2023-08 adopted 2024,2024-03 pending -"), ("None.", "")], lambda t: F.array_join(F.transform(conclusions.standards_told(t), lambda x: F.concat_ws(" ", x["code"], x["status"], F.coalesce(x["year"].cast("string"), F.lit("-")))), ","))
_cases("going_concern_buckets", [("none", "no_conclusion"), ("risk_factor_only", "no_conclusion"), ("substantial_doubt", "substantial_doubt")], conclusions.bucket)

CONTROL = [
    ("A material weakness is a deficiency of some kind. Our internal control over financial reporting was effective.", "effective"),
    ("Our internal control over financial reporting was not effective because of a material weakness in the close.", "material_weakness"),
    ("We evaluated our disclosure controls and procedures.", ""),
    ("Internal control over financial reporting was not effective, so that we cannot conclude that it is effective.", "material_weakness"),
    ("Failures of control could harm our business.", ""),
    (None, None),
]
_cases("control_cases", CONTROL, conclusions.control_state)
_cases("adoption_cases", [("The FASB issued ASU 2024-03 in November.", "pending"), ("The Company adopted ASU 2024-03 on January 1, 2025.", "adopted"), ("Nothing new.", None), ("The Board issued ASU 2024-03, which we will adopt later.", "pending")], lambda t: conclusions.adoption(t, "2024-03"))
_cases("adoption_year_cases", [("We adopted the update on January 1, 2021.", 2021), ("We follow it.", None)], conclusions.adoption_year, "int")
_cases("limb_cases", [("Item 4.02(a) applies. Our accounting firm advised us.", "a"), ("The company was advised by its independent accountants that errors exist.", "b"), ("The audit committee concluded that the accounts are wrong.", "a"), ("Nothing of note.", None), (None, None)], items.non_reliance_limb)
_cases(
    "auditor_direction_cases",
    [("The Board dismissed its accounting firm.", "dismissed"), ("Our accounting firm resigned in May.", "resigned"), ("The auditors declined to stand for a new term.", "declined"), ("The auditor withdrew its report and was dismissed.", "withdrawn"), ("We terminated our Sales Agreement.", None), ("We terminated the engagement of our independent accounting firm.", "dismissed")],
    items.auditor_direction,
)
_cases("disagreement_cases", [("There were no (i) disagreements on any matter.", False), ("There was a disagreement about scope.", True), ("No disagreements arose in 2023, yet a disagreement arose in 2024.", True), ("We changed firms.", None), ("It is not the result of any quarrel.", False)], items.disagreements, "boolean")
_cases(
    "officer_cases",
    [("Our Chief Financial Officer resigned. The Board appointed a new one.", "normal"), ("The CFO resigned following a disagreement with the Board.", "high"), ("A director resigned. The Chief Financial Officer signs below.", None), ("The CFO will leave in June. We have not yet named a successor.", "high"), ("The CFO resigned. There were no disagreements with the Board.", "normal"), (None, None)],
    items.officer_severity,
)
_cases("ticked_cases", [("Have all reports been filed? [ ] Yes [X] No", False), ("Have all reports been filed? Yes ☒ No ☐", True), ("Have all reports been filed? [X] Yes [X] No", None), ("Have all reports been filed? Yes No", None)], lambda t: items.ticked(t, "reports been filed"), "boolean")
_cases("period_cases", [("For the period ended: June 30, 2026", "2026-06-30"), ("For the Period Ended 6/30/2026", "2026-06-30"), ("period ended 2026-06-30", "2026-06-30"), ("period ended February 31, 2026", None), ("no period", None)], items.period_on_form)
_cases(
    "late_severity_cases",
    [("We found errors in prior accounts.", "high"), ("The books are not closed.", "normal"), ("An internal review goes on.", "high"), ("The chief financial officer resigned and fraud is suspected.", "high"), ("We filed under Chapter 11 in May.", "high"), ("An impairment is looked at.", "high"), (None, "normal")],
    lambda t: items.late_severity(t, F.lit(None).cast("int"), F.lit(None).cast("boolean"), F.lit(None).cast("boolean"), F.lit(False)),
)
_cases("late_reason_cases", [("PART III — NARRATIVE State below in reasonable detail why. The company could not close its ledgers before the day on which the report was due. PART IV", "The company could not close its ledgers before the day on which the report was due."), ("PART I only", "")], items.late_reason)
_cases("review_subject_cases", [("Form 10-K for the year 2025", True), ("Registration Statement on Form S-1", False), ("Schedule 13E-3", False), ("", False), (None, False)], items.reviews_a_periodic_report, "boolean")
_cases("subject_line_cases", [("Dear Sir:\nRe:  Acme Corp\n Form 10-K", "Acme Corp Form 10-K"), ("None", "")], items.subject_line)
_cases(
    "topic_cases",
    [("Your goodwill test and the reportable segment note.", "Goodwill and impairment,Segment reporting"), ("Please respond.", ""), ("The lease term under ASC 842 and ASC 606.", "Leases,Revenue recognition"), ("How bitcoin enters your MD&A and adjusted EBITDA.", "Crypto assets,MD&A,Non-GAAP measures"), ("The reverse merger.", "Business combinations")],
    lambda t: F.array_join(items.topics(t), ","),
)
_cases(
    "citation_cases",
    [("Note 2 Revenue Recognition, page 60. See note 2 revenue  recognition, page 61; Item 9A. Controls, page 12 and ASC 606.", "Note 2 Revenue Recognition, page 60|Item 9A. Controls, page 12"), ("None.", ""), ("Item 1, page 2, Item 2, page 3, Item 3, page 4, Item 4, page 5, Item 5, page 6", "Item 1, page 2|Item 2, page 3|Item 3, page 4|Item 4, page 5")],
    lambda t: F.array_join(items.citations(t), "|"),
)
_cases("firm_key_cases", [("OakField CPAs", "oakfield"), ("Oak Field CPA", "oakfield"), ("Pell, Marrow and Dunst, L.L.P.", "pellmarrowdunst"), ("Pell, Marrow & Dunst LLP (PCAOB ID 12)", "pellmarrowdunst"), ("Tran Brothers & Co. LLP", "tranbrothersco"), ("KPMG LLP", "kpmg")], firms.firm_key)
_cases("firm_label_cases", [("Tran Brothers & Co. LLP", "Tran Brothers & Co. LLP"), ("Some Firm LLP (PCAOB ID 12)", "Some Firm LLP"), ("BDO USA, P.C.", "BDO")], firms.firm_label)
_cases("firm_tier_cases", [("Deloitte & Touche LLP", "big_four"), ("Crowe LLP", "national"), ("Small & Co", "other"), (None, "other")], firms.firm_tier)
_cases("outgoing_firm_cases", [("The Board dismissed Alder & Birch LLP as its auditor.", "Alder & Birch LLP"), ("We dismissed Oak Law LLP, our counsel, last week.", ""), ("Nothing happened.", "")], spans.outgoing_firm)
_cases("item_body_cases", [("Item 4.01 short. Item 4.01 This passage is longer. Item 9.01 Exhibits", "This passage is longer."), ("no items", "no items")], lambda t: spans.item_body(t, "4.01"))
_cases("note_cases", [("NOTE 1 — Basis\nx\nNOTE 2 — Going Concern\n" + "The losses raise substantial doubt. " * 8 + "\n3. Revenue\nmore", ("The losses raise substantial doubt. " * 8).strip()), ("We may go on as a going concern, we think.\nx", "")], lambda t: spans.note_under(t, "going concern", "doubt"))
_cases("business_replaced_cases", [("After the reverse acquisition we sell pumps.", True), ("We sell pumps.", False), (None, False)], lambda t: items.business_replaced(F.lit(True), t, F.lit("We sold soap.")), "boolean")
_cases("blank_check_cases", [("We have until May for our initial business combination.", True), ("We sell soap.", False), (None, False)], lambda t: items.blank_check(F.lit("Soap Inc"), F.lit(2000), t), "boolean")
_cases("revenue_marker_cases", [("Each performance obligation has a transaction price under ASC 606.", 3), ("Sales rose.", 0)], conclusions.revenue_markers, "int")
_cases("html_cases", [("<p>A&amp;B</p><script>x</script><b>C</b>D<br/>E &eacute; &#8217;", "A&B\nCD\nE é ’"), ("plain  text", "plain text"), (None, None), ("<!-- c -->x\n\n\n<td>y</td>", "x\ny")], text.html_to_text)
_cases("heading_cases", [("Going Concern", True), ("ability to continue as a going concern;", False), ("", False)], text.looks_like_heading, "boolean")
_cases("open_quote_cases", [("2. Going Concern follows", "Going Concern follows"), ("controls and procedures", "… controls and procedures"), ("The start", "The start"), ("16 Credit Losses", "Credit Losses")], text.open_quote)
_cases("mid_sentence_cases", [("Revenue recognition", "revenue recognition"), ("SEC letter", "SEC letter")], text.mid_sentence)
_cases("due_date_cases", [("NT 10-Q", "2026-08-14"), ("NT 10-K", "2026-09-28"), ("NT 11-K", "2026-08-14")], lambda t: scalars.due_date(F.lit("2026-06-30").cast("date"), t, F.lit("small")))
_cases("lateness_cases", [("0", "current"), ("1", "1 business day behind"), ("3", "3 business days behind")], lambda t: scalars.lateness(t.cast("int")))
_cases("money_cases", [("1720000000", "$1.7B"), ("88000000", "$88M"), (None, "")], lambda t: scalars.money(t.cast("double")))
_cases("percent_cases", [("1", "12%"), ("3", "38%"), ("0", "0%")], lambda t: scalars.percent(t.cast("int"), F.lit(8)))
_cases("boilerplate_cases", [("We identify the contract with a customer. Our pumps ship in May.", "Our pumps ship in May."), ("We determine the transaction price; the following five steps apply. A pump is a pump.", "A pump is a pump."), ("Nothing of that.", "Nothing of that.")], lambda t: text.drop_sentences(t, conclusions.BOILERPLATE))
_cases("verified_tier_cases", [("2e10", ""), ("8e7", "mid"), ("9e8", "large")], lambda t: scalars.verified_tier(t.cast("double"), F.when(t == "2e10", 1e7).otherwise(F.lit(None))))
_cases("tier_downgrade_cases", [("big_four>other", True), ("other>national", False), ("big_four>", None)], lambda t: items.tier_downgrade(F.split(t, ">")[0], F.split(t, ">")[1]), "boolean")
_cases("auditor_severity_cases", [("resigned", "high"), ("declined", "elevated"), ("dismissed", "normal")], lambda t: items.auditor_severity(t, F.lit(None).cast("boolean"), F.lit(False)))
_cases("amendment_cases", [("This amendment is filed solely to add Exhibit 16.1.", True), ("The sole purpose is to correct the signature block.", True), ("This amendment corrects the date of dismissal.", False), (None, False)], items.only_the_letter, "boolean")
_LONG = "We look at the notes to the accounts with care. " * 9
_cases("letter_admission_cases", [(_LONG + "Please tell us why.", True), ("Please tell us why.", False), (_LONG, False)], lambda t: items.admits_letter(t, F.lit(True)), "boolean")
_cases("first_comment_cases", [("Jan 5\nDear Ms. Roe:\nWe have reviewed your filing. 1. Tell us how you judged control over the agent in note 3. Sincerely, X", "Tell us how you judged control over the agent in note 3.")], items.first_comment)
_RISKS = "Item 1A. Risk Factors\nOur losses raise substantial doubt about our ability to continue.\nItem 2. Properties\nNone."
_cases(
    "document_concern_cases",
    [(_RISKS, "risk_factor_only"), ("We sell soap.", "none"), ("There is much loss. These losses raise substantial doubt about our ability to continue as a going concern.", "substantial_doubt"), ("NOTE 2 — Going Concern\n" + "We concluded that substantial doubt exists. " * 6 + "\n3. Debt\nx", "substantial_doubt"), (None, None)],
    spans.document_concern,
)
_GOOD, _BAD = "Our internal control over financial reporting was effective.", "Our internal control over financial reporting was not effective."
_cases(
    "document_control_cases",
    [(f"Item 9A. Controls and Procedures\n{_GOOD}\nItem 10. Directors\nNone.\nItem 9A. Controls and Procedures\n{_BAD}\nItem 10. Directors\n{_GOOD}", "material_weakness"), (f"Controls and Procedures\n{_BAD}\nItem 15. Exhibits\nNone.\nControls and Procedures\nSee above.", "material_weakness"), (f"{_GOOD} Controls and Procedures\nNothing is judged.\n", "effective"), (f"Controls and Procedures\nNothing is judged.\nItem 10. Directors\n{_GOOD}", ""), (f"Item 1A. Risk Factors\n{_BAD}\nItem 2. Properties\nNone.", ""), (_GOOD, "effective"), (None, None)],
    spans.document_control,
)
_POLICY = "We count revenue when a performance obligation is met; the transaction price of contracts with customers is set in advance. " * 4
_cases("revenue_note_cases", [("2. Revenue Recognition\n" + _POLICY + "\n3. Debt\nNone", _POLICY.strip()), ("Revenue Recognition\nShort.", ""), ("No such note.", "")], spans.revenue_note)
_cases("excerpt_cases", [("One is here. Two has the word alpha in it.", "One is here. Two has the word alpha in it."), ("nothing", None)], lambda t: spans.around(t, "alpha"))
_cases("compatible_cases", [("\uff21\ufb01", "Afi"), ("plain", "plain")], spans.compatible)
