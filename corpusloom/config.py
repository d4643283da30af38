"""Defaults and pattern lists. What belongs to one organisation is a parameter."""

from __future__ import annotations

from dataclasses import dataclass

# Sizes in tokens, thresholds and limits that results depend on.
CHUNK_SIZE = 400
CHUNK_OVERLAP = 60
MIN_CHUNK = 100
TOKEN_LIMIT = 512
CONTEXT_WORDS = 50
NOISE_THRESHOLD = 0.8
REPEATED_LINE = 3
MAX_RETRIES = 3
STUCK_MINUTES = 30

# Manuals and their acronyms.
MANUALS = {
    "Administration": "ADM",
    "Care": "CARE",
    "Emergency Planning and Management": "EPM",
    "Environmental Services": "EVS",
    "Infection Prevention and Control": "IPC",
    "Legal": "LEG",
    "Maintenance": "MAINT",
    "Privacy and Confidentiality": "PRV",
    "RC": "RC",
}

# General noise, matched by line (multi-line mode).
NOISE_PATTERNS = [
    r"Page \d+ of \d+",
    r"^\d+$",
    r"Printed on: \d{1,2}/\d{1,2}/\d{4}",
    r"Last updated: \d{1,2}/\d{1,2}/\d{4}",
    r"[A-Za-z]:\\[^\\]+\\[^\\]+",
    r"https?://[^\s]+",
    r"\s*\|\s*\|\s*",
    r"_{3,}",
    r"-{3,}",
    r"\.{3,}\d+",
    r"\d+\s*\.{3,}",
]

# Headers and footers, matched at the start of a stripped line without regard to case.
HEADER_PATTERNS = [
    r"^[A-Z][a-z]+ Manual\s*$",
    r"^[A-Z]{2,5}\d*-[A-Z]\d+\.\d+",
    r"^Section \d+:.*$",
    r"^SECTION \d+:.*$",
    r"^.*Administration.*$",
    r"^.*Care.*$",
    r"^.*Emergency Planning.*$",
    r"^.*Environmental Services.*$",
    r"^.*Infection Prevention.*$",
    r"^.*Legal.*$",
    r"^.*Maintenance.*$",
    r"^.*Privacy.*$",
]


@dataclass(frozen=True)
class Organisation:
    """Whose notices are removed: a regular expression for its name, and its tagline.

    The defaults are invented. Notices of a real organisation go only if the caller names it here.
    """

    name: str = r"Example Homes Inc\."
    short: str = "Example Homes"
    tagline: str = r"Working for better days\.?"

    def disclaimers(self) -> list[str]:
        """Notices in the order in which they are removed (any case, dot matches newlines)."""
        secret = rf"Confidential and Proprietary Information of {self.name} © \d{{4}}"
        # Wordings of notices around the organisation's name.
        return [
            r"\*This document is uncontrolled when printed\.\*",
            r"This document is uncontrolled when printed\.?",
            rf"\*{self.name} will provide, on request, information in an accessible format or\*",
            r"\*with communication supports to people with disabilities, in a manner that takes into account\*",
            rf"\*their disability\. {secret}\*",
            rf"\*{self.name} will provide.*?© \d{{4}}\*",
            self.tagline,
            secret,
            rf"© \d{{4}} {self.name}",
            r"Document ID: [A-Z]+-[A-Z0-9\.-]+",
            r"Effective Date: \d{1,2}/\d{1,2}/\d{4}",
            r"Review Date: \d{1,2}/\d{1,2}/\d{4}",
            r"Revision: \d+(?:\.\d+)?",
            r"This document is proprietary and confidential",
            rf"Not for distribution outside of {self.short}",
        ]

    def fast(self) -> str:
        """One pattern for the fast cleaner."""
        return rf"\*This document is uncontrolled when printed\.\*|{self.tagline}|Page \d+ of \d+|Confidential and Proprietary Information.*?© \d{{4}}"
