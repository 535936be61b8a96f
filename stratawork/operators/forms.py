"""Field extraction from page text by tables of anchored patterns, typed views and the transposed summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.functions.columns import any_date, currency, text

#: Of a benefit statement: (field, pattern, groups whose trimmed values are joined with ', ', type). Values may stand before their labels. Fixed values; the company is synthetic.
STATEMENT_FIELDS = [
    ("issuing_entity", r"(Example Life Insurance Company \(U\.S\.A\.\))", (1,), "text"),
    ("page_number", r"Page (\d+) of (\d+)", (1,), "count"),
    ("page_total", r"Page (\d+) of (\d+)", (2,), "count"),
    ("claim_id", r"Claim ID:\s*\n([A-Z0-9]+)", (1,), "text"),
    ("group_nbr", r"Group Nbr:\s*\n(\d+)", (1,), "text"),
    ("payment_date", r"(?s)\A(?:(?!Payment Amount:).)*?(\d{1,2}/\d{1,2}/\d{4})", (1,), "date"),
    ("payment_amount", r"Payment is being made to:\s*\n(\$[\d,]+\.?\d*)", (1,), "money"),
    ("transaction_seq", r"(\d{5,7}/[A-Z])\s*\nTransaction Seq", (1,), "text"),
    ("insured_name", r"Insured:\s*\n([^\n]+)\n([^\n]+)\n([^\n]+)\n([^\n]+)", (1,), "text"),
    ("payment_recipient_name", r"Insured:\s*\n([^\n]+)\n([^\n]+)\n([^\n]+)\n([^\n]+)", (2,), "text"),
    ("insured_address", r"Insured:\s*\n([^\n]+)\n([^\n]+)\n([^\n]+)\n([^\n]+)", (3, 4), "text"),
    ("payment_recipient_address", r"Transaction Seq\. Nbr\.:\s*\n([^\n]+)\n([^\n]+)", (1, 2), "text"),
    ("total_charge", r"(\$[\d,]+\.?\d*)\n(\$[\d,]+\.?\d*)\n(\$[\d,]+\.?\d*)\nHome Health", (1,), "money"),
    ("exceeds_plan_max", r"(\$[\d,]+\.?\d*)\n(\$[\d,]+\.?\d*)\n(\$[\d,]+\.?\d*)\nHome Health", (2,), "money"),
    ("benefit_paid", r"(\$[\d,]+\.?\d*)\n(\$[\d,]+\.?\d*)\n(\$[\d,]+\.?\d*)\nHome Health", (3,), "money"),
    ("service_type", r"(Home Health[^\n]+)\n([\d/]+) - ([\d/]+)\n([^\n]+)", (1,), "text"),
    ("service_date_from", r"(Home Health[^\n]+)\n([\d/]+) - ([\d/]+)\n([^\n]+)", (2,), "date"),
    ("service_date_to", r"(Home Health[^\n]+)\n([\d/]+) - ([\d/]+)\n([^\n]+)", (3,), "date"),
    ("provider", r"(Home Health[^\n]+)\n([\d/]+) - ([\d/]+)\n([^\n]+)", (4,), "text"),
    ("lifetime_used", r"used (\$[\d,]+\.?\d*) of your (\$[\d,]+\.?\d*) lifetime maximum", (1,), "money"),
    ("lifetime_maximum", r"used (\$[\d,]+\.?\d*) of your (\$[\d,]+\.?\d*) lifetime maximum", (2,), "money"),
]
#: Of an invoice's first page. Fixed values.
INVOICE_FIELDS = [
    ("policy_number", r"Policy Number:\s*(\S+)", (1,), "text"),
    ("claim_number", r"Claim Number:\s*(\S+)", (1,), "text"),
    ("provider_name", r"Provider:\s*(.+?)(?:\s{2,}|$|\n)", (1,), "text"),
    ("total_charges", r"Total Charges:\s*\$?([\d,]+\.?\d*)", (1,), "dollars"),
    ("hourly_rate", r"Hourly Rate:\s*\$?([\d,]+\.?\d*)", (1,), "dollars"),
    ("service_date_from", r"Service Date From[:\s]*([\d/]+)", (1,), "date"),
    ("service_date_to", r"Service Date To[:\s]*([\d/]+)", (1,), "date"),
    ("submitted_by", r"Submitted By:\s*(.+?)(?:\n|Date Submitted)", (1,), "text"),
    ("date_submitted", r"Date Submitted:\s*([\d/]+)", (1,), "date"),
    ("provider_phone", r"Phone Number:\s*(\d+)", (1,), "text"),
    ("provider_email", r"Email Address:\s*(\S+)", (1,), "text"),
    ("care_at_home", r"(?s)Q1:.*?at home\?\s*\n\s*([^\n]+)", (1,), "text"),
    ("q1a_response", r"(?s)Q1a\..*?what dates\?\s*\n\s*([^\n]+)", (1,), "text"),
    ("shared_care", r"(?s)Q2\..*?with you\?\s*\n\s*([^\n]+)", (1,), "text"),
    ("q2a_who_else", r"(?s)Q2a\..*?for\?\s*\n\s*([^\n]+)", (1,), "text"),
    ("q2b_own_customer", r"(?s)Q2b\..*?customer\?\s*\n\s*([^\n]+)", (1,), "text"),
    ("q2c_other_policy", r"(?s)Q2c\..*?ID:\s*\n\s*([^\n]+)", (1,), "text"),
    ("q2d_other_claim", r"(?s)Q2d\..*?number:\s*\n\s*([^\n]+)", (1,), "text"),
    ("assignment_of_benefits", r"(?s)Q3\..*?this provider\?\s*\n\s*([^\n]+)", (1,), "text"),
    ("proof_of_payment_type", r"(?s)Q4\..*?type:\s*\n\s*([^\n]+)", (1,), "text"),
    ("q4a_payment_desc", r"(?s)Q4a\..*?description:\s*\n([^\n]+)", (1,), "text"),
]
#: Of a file's name, of either page in turn, and what an invoice is. Fixed values; the company is synthetic.
NAME_NUMBER, NAME_DATE, PAGE_NUMBER = r"Invoice_(\d+)_", r"_(\d{4}-\d{2}-\d{2})_", r"\bI-(\d+)\b"
MORE, MORE_ENDS = r"Additional Information:\s*\n[ \t]*([^\n]+)", "Fraud Attestation"
ATTEST, PROOF = "I attest to the knowledge that", "I attest that I have submitted proof of payment"
ATTEST_TEXT, PROOF_TEXT = rf"(?s){ATTEST}(.+?)(?=\nI attest that I have|\n+I-\d+\b|\z)", rf"(?s){PROOF}(.+?)(?=\n+I-\d+\b|\z)"
CONSTANT_FIELDS = {"doc_type": "Claim_Invoice", "doc_subtype": "Invoice_Cover_Sheet", "issuing_entity": "Example Life Insurance Company (U.S.A.)"}
#: Fields that older forms do not ask for, and what stands in their place.
NOT_ASKED = ["assignment_of_benefits", "shared_care", "q2a_who_else", "q2b_own_customer", "q2c_other_policy", "q2d_other_claim", "proof_of_payment_type", "q4a_payment_desc", "proof_payment_attested", "proof_payment_attest_text"]
PLACEHOLDER = "Question not asked"
#: Characters from which a second page counts as text.
PAGE_TEXT = 100


def found(page: Column, pattern: str, groups: tuple[int, ...] = (1,)) -> Column:
    """The trimmed groups of the first match, joined with ', '; null without a match or with empty groups."""
    parts = [F.trim(F.regexp_replace(F.regexp_extract(text(page), pattern, g), r"^\s+|\s+$", "")) for g in groups]
    return F.nullif(F.concat_ws(", ", *parts), F.lit("")) if len(parts) == 1 else F.when(text(page).rlike(pattern), F.concat_ws(", ", *parts))


def _entries(pairs: dict[str, Column]) -> Column:
    """map<field, value> without the nulls."""
    each = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs.items()))
    return F.map_from_entries(F.filter(each, lambda x: x["value"].isNotNull()))


def extract(page: Column, fields=STATEMENT_FIELDS) -> Column:
    """map<field, raw value> of the fields that are found on a page."""
    out = {}
    for name, pattern, groups, kind in fields:
        value = found(page, pattern, groups)
        out[name] = F.concat(F.lit("$"), value) if kind == "dollars" else value
    return _entries(out)


def invoice(page1: Column, page2: Column | None = None, file_name: Column | None = None, page_count: Column | None = None) -> Column:
    """map<field, raw value> of an invoice: its name, its first page, and what may stand on a second page that holds text."""
    first, name = text(page1), text(file_name) if file_name is not None else F.lit("")
    second = F.when(F.length(F.trim(text(page2))) > PAGE_TEXT, text(page2)).otherwise("") if page2 is not None else F.lit("")
    both = F.when(second != "", F.concat(first, F.lit("\n"), second)).otherwise(first)
    more = [F.when(~x.startswith(MORE_ENDS), x) for x in (found(first, MORE), found(second, MORE))]
    one_line = lambda label, pattern: F.concat(F.lit(label), F.regexp_replace(found(both, pattern), "\n", " "))
    out = {"invoice_number": F.coalesce(found(name, NAME_NUMBER), found(first, PAGE_NUMBER), found(second, PAGE_NUMBER)), "doc_date": found(name, NAME_DATE)}
    out["page_count"] = page_count.cast("string") if page_count is not None else F.lit(None).cast("string")
    out |= {k: F.lit(v) for k, v in CONSTANT_FIELDS.items()}
    for field, pattern, groups, kind in INVOICE_FIELDS:
        value = found(first, pattern, groups)
        out[field] = F.concat(F.lit("$"), value) if kind == "dollars" else value
    out["additional_info"] = F.coalesce(*more)
    out["fraud_attestation_checked"] = F.when(both.rlike(ATTEST_TEXT), "Yes").otherwise("No")
    out["fraud_attestation_text"] = one_line(f"{ATTEST}", ATTEST_TEXT)
    out["proof_payment_attested"] = F.when(both.rlike(PROOF_TEXT), "Yes")
    out["proof_payment_attest_text"] = one_line(f"{PROOF}", PROOF_TEXT)
    return _entries(out)


def shown(values: Column, field: str, not_asked=NOT_ASKED, placeholder: str = PLACEHOLDER, missing: str = "not extracted") -> Column:
    """A field for display: what was found, else that an older form does not ask for it, else that it was not found."""
    return F.coalesce(values[field], F.lit(placeholder if field in not_asked else missing))


def typed(values: Column, fields=STATEMENT_FIELDS) -> list[Column]:
    """A typed column a field, and the raw one beside it, since a value that does not fit is kept as it was."""
    casts = {"money": currency, "dollars": currency, "date": any_date, "count": lambda c: c.try_cast("bigint"), "text": lambda c: c}
    out = []
    for name, _, _, kind in fields:
        out += [casts[kind](values[name]).alias(name), values[name].alias(f"{name}_raw")]
    return out


def page_lines(spans: DataFrame, key: str, page: str, order: str, span: str) -> DataFrame:
    """(key, page, text): the trimmed spans of each page that are not blank, in order, a line each."""
    s = spans.select(key, page, order, F.trim(span).alias("__s")).filter("__s <> ''")
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, "__s"))), lambda x: x["__s"])  # a page's own spans
    return s.groupBy(key, page).agg(F.array_join(lines, "\n").alias("text"))


def summary(df: DataFrame, key: str, values: str, names: list[str]) -> DataFrame:
    """Fields as rows, documents as columns."""
    return df.select(key, F.explode(values).alias("field", "value")).groupBy("field").pivot(key, names).agg(F.first("value"))
