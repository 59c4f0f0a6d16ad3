"""Mail-server greetings: parsing and ordered rule lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelens.functions.hosts import strip

BANNER_VERSION = "2025.10.21-rc1"

# Greeting shapes.  The open one also takes text that goes on without the SMTP word.
ANCHORED = r"(?i)^\s*220\s+(\S+)(?:\s+(?:E?SMTP)\s*(.*))?$"
OPEN = r"(?i)^220\s+(\S+)(?:\s+(?:E?SMTP)\s*(.*))?"


@dataclass(frozen=True)
class Rule:
    """One row of an ordered rule list; a blank pattern matches anything."""

    host: str
    details: str
    provider: str
    category: str
    confidence: int = 80


# Fingerprints used for features.  The first match wins.
FINGERPRINTS = (
    Rule(r"(?:^|\.)google\.com$", r"\bgsmtp\b", "Google Workspace", "enterprise", 95),
    Rule(r"(?:mail\.|.*\.)protection\.outlook\.com$", "", "Microsoft 365 (EOP)", "enterprise", 95),
    Rule(r"(?:^|\.)outlook\.com$", "", "Microsoft 365 (Outlook)", "enterprise", 85),
    Rule(r"(?:^|\.)pphosted\.com$", r"\bproofpoint\b", "Proofpoint", "seg", 95),
    Rule(r"(?:^|\.)mimecast\.com$", r"\bmimecast\b", "Mimecast", "seg", 95),
    Rule(r"(?:^|\.)secureserver\.net$|(?:^|\.)iphmx\.com$", r"\b(ironport|cisco)\b", "Cisco IronPort", "seg", 90),
    Rule(r"(?:^|\.)barracudanetworks\.com$", r"\bbarracuda\b", "Barracuda", "seg", 90),
    Rule(r"(?:^|\.)sendgrid\.net$", r"\bsendgrid\b", "SendGrid", "esp", 85),
    Rule(r"(?:^|\.)mailgun\.net$", r"\b(mailgun|mxmg)\b", "Mailgun", "esp", 85),
    Rule(r"(?:^|\.)amazonses\.com$", "", "Amazon SES", "esp", 80),
    Rule(r"(?:^|\.)sparkpostmail\.com$", r"\bsparkpost\b", "SparkPost", "esp", 80),
    Rule(r"(?:^|\.)zoho\.com$", r"\bzoho\b", "Zoho Mail", "enterprise", 85),
    Rule("", r"\bpostfix\b", "Postfix", "self_hosted", 70),
    Rule("", r"\bexim\b", "Exim", "self_hosted", 70),
    Rule("", r"\bharaka\b", "Haraka", "self_hosted", 70),
    Rule("", r"\bopensmtpd\b", "OpenSMTPD", "self_hosted", 70),
)

# Classifier rules used where no rule file is given.
CLASSIFIER = (
    Rule(r"(mx|smtp)\.google\.com|googlemail\.com", "", "Google", "Mailbox Provider", 95),
    Rule("", "gsmtp", "Google", "Mailbox Provider", 85),
    Rule(r"(outlook|office365|protection\.outlook)\.com", "", "Microsoft", "Mailbox Provider", 95),
    Rule("", "microsoft", "Microsoft", "Mailbox Provider", 85),
    Rule("", "proofpoint", "Proofpoint", "Security Gateway", 90),
    Rule("", "mimecast", "Mimecast", "Security Gateway", 90),
    Rule("", "barracuda", "Barracuda", "Security Gateway", 85),
    Rule("", "mailgun", "Mailgun", "Transactional", 90),
    Rule("", "sendgrid", "SendGrid", "Transactional", 90),
    Rule("", "amazonses", "Amazon SES", "Transactional", 90),
    Rule("", r"\bpostfix\b", "Postfix", "Self-hosted MTA", 80),
    Rule("", r"\bexim\b", "Exim", "Self-hosted MTA", 75),
    Rule("", r"\bharaka\b", "Haraka", "Self-hosted MTA", 70),
    Rule("", r"\bqmail\b", "Qmail", "Self-hosted MTA", 70),
)

# The rules of the shipped rule file.
RULE_FILE = (
    Rule(r"(mx|smtp)\.google\.com|googlemail\.com", "", "Google", "Mailbox Provider", 95),
    Rule("", "outlook|office365|microsoft", "Microsoft", "Mailbox Provider", 90),
    Rule("", "gsmtp", "Google", "Mailbox Provider", 85),
    Rule("", "proofpoint", "Proofpoint", "Security Gateway", 90),
    Rule("", "mimecast", "Mimecast", "Security Gateway", 90),
    Rule("", "barracuda", "Barracuda", "Security Gateway", 85),
    Rule("", "mailgun", "Mailgun", "Transactional", 90),
    Rule("", "sendgrid", "SendGrid", "Transactional", 90),
    Rule("", "amazonses", "Amazon SES", "Transactional", 90),
    Rule("", "postfix", "Postfix", "Self-hosted MTA", 80),
    Rule("", "exim", "Exim", "Self-hosted MTA", 75),
    Rule("", "haraka", "Haraka", "Self-hosted MTA", 70),
    Rule("", "qmail", "Qmail", "Self-hosted MTA", 70),
)

# Hints searched in host and details together.
HINTS = (
    Rule(r"\bgoogle\b|\bgsmtp\b|\baspmx\b", "", "Google Workspace", "EnterpriseMail"),
    Rule(r"\b(outlook|protection\.outlook|mail\.mailprotect\.microsoft)\b", "", "Microsoft 365", "EnterpriseMail"),
    Rule(r"\bpphosted\.com\b|\bproofpoint\b", "", "Proofpoint", "SEG"),
    Rule(r"\bmimecast\b", "", "Mimecast", "SEG"),
    Rule(r"\bzoho\b", "", "Zoho Mail", "EnterpriseMail"),
    Rule(r"\bmailgun\b|\bmailgun\.org\b", "", "Mailgun", "TransactionalMail"),
    Rule(r"\bsendgrid\b|\bsendgrid\.net\b", "", "SendGrid", "TransactionalMail"),
    Rule(r"\bamazonses\.com\b|\bses\b", "", "Amazon SES", "TransactionalMail"),
)


def banner_line(raw: Column) -> Column:
    """First line of a reply that starts with 220, trimmed."""
    lines = F.transform(F.split(raw, r"\R"), strip)
    return F.get(F.filter(lines, lambda x: F.startswith(x, F.lit("220"))), F.lit(0))


def parse_banner(banner: Column, anchored: bool = True) -> tuple[Column, Column]:
    """Announced host and software details; both null where the text is no greeting."""
    pattern = ANCHORED if anchored else OPEN
    line = strip(banner)
    hit = line.rlike(pattern)
    host = F.when(hit, F.regexp_extract(line, pattern, 1))
    details = F.when(hit, strip(F.coalesce(F.regexp_extract(line, pattern, 2), F.lit(""))))
    return host, details


def first_match(rules: Sequence[Rule], host: Column, details: Column, unknown: tuple, ignore_case: bool = True) -> Column:
    """Struct (provider, category, confidence) of the first rule that matches, as one CASE chain."""
    flag = "(?i)" if ignore_case else ""

    def verdict(provider: str | None, category: str | None, confidence: int) -> Column:
        return F.struct(
            F.lit(provider).cast("string").alias("provider"),
            F.lit(category).cast("string").alias("category"),
            F.lit(confidence).cast("int").alias("confidence"),
        )

    h = F.coalesce(host, F.lit(""))
    d = F.coalesce(details, F.lit(""))
    chain = None
    for rule in rules:
        test = F.lit(True)
        if rule.host:
            test = test & h.rlike(flag + rule.host)
        if rule.details:
            test = test & d.rlike(flag + rule.details)
        answer = verdict(rule.provider, rule.category, rule.confidence)
        chain = F.when(test, answer) if chain is None else chain.when(test, answer)
    fallback = verdict(*unknown)
    return fallback if chain is None else chain.otherwise(fallback)


def infer_provider(host: Column, details: Column) -> Column:
    """Struct (provider, category, ...) from hints in host and details; null fields where none fits."""
    text = F.concat_ws(" ", F.coalesce(host, F.lit("")), F.coalesce(details, F.lit("")))
    return first_match(HINTS, text, F.lit(""), (None, None, 0))
