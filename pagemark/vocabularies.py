"""Label vocabularies a model's class ids refer to."""

from __future__ import annotations

# The invoice and receipt labels annotators choose from.
INVOICE_LABELS = [
    "address_extra",
    "adjust_discount_a_li",
    "adjust_discount_a_pg",
    "adjust_discount_q_li",
    "adjust_discount_q_pg",
    "balance_a_li",
    "balance_a_pg",
    "balance_q_li",
    "balance_q_pg",
    "bank_acc_name_extra",
    "bank_acc_number_extra",
    "bank_bsb_extra",
    "date_a_li",
    "date_q_li",
    "desc_a_li",
    "desc_q_li",
    "due_a_li",
    "due_a_pg",
    "due_q_li",
    "due_q_pg",
    "emails_extra",
    "fee_help_a_li",
    "fee_help_q_li",
    "header_a_pg",
    "invDate_a_pgs",
    "invDate_q_pgs",
    "other",
    "payDate_a_pgs",
    "payDate_q_pgs",
    "payer_a_pgs",
    "payer_q_pgs",
    "phones_extra",
    "quantity_a_li",
    "quantity_q_li",
    "received_a_li",
    "received_a_pg",
    "received_q_li",
    "received_q_pg",
    "subtotal_a_li",
    "subtotal_a_pg",
    "subtotal_q_li",
    "subtotal_q_pg",
    "supplier_a_pgs",
    "supplier_q_pgs",
    "supplierABN_a_pgs",
    "tax_a_li",
    "tax_a_pg",
    "tax_q_li",
    "tax_q_pg",
    "total_a_li",
    "total_a_pg",
    "total_a_pgs",
    "total_q_li",
    "total_q_pg",
    "total_q_pgs",
    "unit_price_a_li",
    "unit_price_q_li",
    "website_extra",
]

# Entity types, each with a B- and an I- form; the position is the class id.
ENTITY_TYPES = [
    "PER",
    "ORG",
    "LOC",
    "DATE",
    "MONEY",
    "MISC",
    "ADDRESS",
    "PHONE",
    "EMAIL",
    "URL",
    "PRODUCT",
    "EVENT",
    "TITLE",
    "QUANTITY",
    "ORDINAL",
    "CARDINAL",
    "FACILITY",
    "GPE",
    "LANGUAGE",
    "NORP",
    "WORK_OF_ART",
    "LAW",
    "TIME",
    "PERCENT",
]

# The layout labels that follow them.
LAYOUT_LABELS = [
    "HEADER",
    "FOOTER",
    "TITLE",
    "SUBTITLE",
    "PARAGRAPH",
    "LIST_ITEM",
    "TABLE_HEADER",
    "TABLE_CELL",
    "CAPTION",
    "FOOTNOTE",
    "PAGE_NUMBER",
    "SECTION",
]


def bio_labels(entity_types: list[str], layout: list[str] = ()) -> list[str]:
    """`O`, then B- and I- per entity type, then the layout labels: the BIO class list."""
    return ["O"] + [f"{p}-{t}" for t in entity_types for p in "BI"] + list(layout)


# Class ids of the annotation labels follow code-point order, those of the BIO labels list order.
INVOICE_VOCABULARY = sorted(INVOICE_LABELS)
BIO_VOCABULARY = bio_labels(ENTITY_TYPES, LAYOUT_LABELS)

# The layout elements scored on their own.
SCORED_LAYOUT = ["HEADER", "FOOTER", "TITLE", "PARAGRAPH", "TABLE_CELL"]
