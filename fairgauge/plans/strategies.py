"""The four prompting strategies and the prompt texts they are built from.

A strategy is a row of parameters — dialect, system text, example block,
token cap — not a copy of the code. Dialect A is the zero-shot form (strict
reply parser, list-style evidence); dialect B is the one-shot and few-shot
form (lenient parser, comma-joined formats).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Prompt texts that must equal the scoring scripts' own, byte
# for byte (checked by md5 in tests/test_prompts.py). Placeholders in braces
# are filled per row.
# ---------------------------------------------------------------------------
RUBRIC = """
Evaluate the FAIR (Findable, Accessible, Interoperable, Reusable) principles using the scoring rubric:

### 1. Findable (Max: 17)
- Identifiers:
  - 8: DOI, PURL, ARK, Handle
  - 3: URL
  - 1: Local ID
  - 0: None
- Identifier in metadata: 1 or 0
- Metadata description:
  - 4: Comprehensive, machine-readable
  - 3: Comprehensive, non-standard
  - 2: Basic title/desc
  - 0: None
- Repository inclusion:
  - 4: Multiple repos
  - 2: General/domain-specific
  - 0: None

### 2. Accessible (Max: 10)
- Data access:
  - 5: Public or stated conditions
  - 4: De-identified subset
  - 3: Embargoed
  - 2: Unclear
  - 1: Metadata only
  - 0: No access
- Online availability:
  - 4: Standard API
  - 3: Non-standard API
  - 2: File download
  - 1: On request
  - 0: None
- Metadata persistence: 1 or 0

### 3. Interoperable (Max: 8)
- Format:
  - 2: Open machine-readable
  - 1: Structured non-machine-readable
  - 0: Proprietary
- Vocab/ontologies:
  - 3: Open & resolvable
  - 2: Standardized only
  - 1: No standard
  - 0: No description
- Metadata linking:
  - 3: Linked data (e.g., RDF)
  - 2: URI links
  - 0: None

### 4. Reusable (Max: 7)
- License:
  - 4: Machine-readable (e.g., CC)
  - 3: Standard text
  - 2: Non-standard
  - 0: No license
- Provenance:
  - 3: Machine-readable
  - 2: Full, text format
  - 1: Partial
  - 0: None
"""

EXAMPLE_EPA = """
Example:

Dataset: "EPA UCMR3 PFAS Data"
Link: https://www.epa.gov/dwucmr/occurrence-data-unregulated-contaminant-monitoring-rule#3

Step-by-step evaluation:
- Findable: URL (3), identifier in metadata (1), basic metadata (3), listed in EPA repo (2) → F-Score = 9/17
- Accessible: Public access (5), direct file download (2), persistent metadata (1) → A-Score = 8/10
- Interoperable: Open CSV format (2), uses standardized vocabularies (3), no linked metadata (2) → I-Score = 7/8
- Reusable: Machine-readable license missing (2), provenance described in text (2) → R-Score = 4/7

Final score:
| Dataset Name | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |

---

Now evaluate the following dataset:
"""

EXAMPLE_NE = """

Example:

Dataset: "National Earthquake Information Database"
Link: https://www.gns.cri.nz/data-and-resources/national-earthquake-information-database/

Step-by-step evaluation:
- Findable: 12/17
- Accessible: 8/10
- Interoperable: 5/8
- Reusable: 5/7

Final score:
| Dataset Name | F-Score (12/17) | A-Score (8/10) | I-Score (5/8) | R-Score (5/7) |

---

Now evaluate the following dataset:
"""

EXAMPLES_FEW_SHOT = """
Example:

Dataset: "EPA UCMR3 PFAS Data"
Link: https://www.epa.gov/dwucmr/occurrence-data-unregulated-contaminant-monitoring-rule#3

Step-by-step evaluation:
- Findable: URL (3), identifier in metadata (1), basic metadata (3), listed in EPA repo (2) → F-Score = 9/17
- Accessible: Public access (5), direct file download (2), persistent metadata (1) → A-Score = 8/10
- Interoperable: Open CSV format (2), uses standardized vocabularies (3), no linked metadata (2) → I-Score = 7/8
- Reusable: Machine-readable license missing (2), provenance described in text (2) → R-Score = 4/7

Final score:
| Dataset Name | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |

---

Example:

Dataset: "National Earthquake Information Database"
Link: https://www.gns.cri.nz/data-and-resources/national-earthquake-information-database/

Step-by-step evaluation:
- Findable: 12/17
- Accessible: 8/10
- Interoperable: 5/8
- Reusable: 5/7

Final score:
| Dataset Name | F-Score (12/17) | A-Score (8/10) | I-Score (5/8) | R-Score (5/7) |

---

Now evaluate the following dataset:
"""

EVIDENCE_A = """
### Extracted Website Content
- Title: {title}
- Description: {description}
- License: {license_info}
- File Formats: {file_formats_list}
- Download Links: {download_links_list}
- Raw Page Text Snippet:
{raw_text_snippet}
"""

INSTRUCTION_A = """
Using ONLY the extracted webpage content above, evaluate the FAIR principles for:

Dataset: "{dataset_name}"
URL: {website_link}

First, think step-by-step internally using the rubric to decide the scores.
Then, provide ONLY the final answer as a markdown table in this exact format:

| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |

Do not include any explanations, reasoning text, or additional commentary in your final output.
"""

EVIDENCE_B = """
### Extracted Website Content for LLM Evaluation
- Title: {title}
- Description: {description}
- License Detected: {license_info}
- File Formats: {file_formats_joined}
- Downloadable Links: {download_links_list}
- Raw Page Text Snippet:
{raw_text_snippet}
"""

INSTRUCTION_B = """
Dataset: "{dataset_name}"
URL: {website_link}

Evaluate the dataset using the extracted website content and the FAIR rubric.
Return ONLY the markdown table:
| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |
"""

SYSTEM_A = "You are an expert in FAIR data assessment. Follow the rubric exactly and be consistent."
SYSTEM_B = "You are an expert in dataset evaluation and FAIR principles assessment."
MODEL = "gpt-4o"
TEMPERATURE = 0.2

#: Principle, letter and maximum score, in rubric order.
PRINCIPLES = [
    ("Findable", "f", 17),
    ("Accessible", "a", 10),
    ("Interoperable", "i", 8),
    ("Reusable", "r", 7),
]

STRATEGIES = [
    {"strategy": "zero_shot", "dialect": "A", "system": SYSTEM_A, "examples": "", "max_tokens": 700},
    {"strategy": "one_shot_epa", "dialect": "B", "system": SYSTEM_B, "examples": EXAMPLE_EPA, "max_tokens": 800},
    {"strategy": "one_shot_ne", "dialect": "B", "system": SYSTEM_B, "examples": EXAMPLE_NE, "max_tokens": 800},
    {"strategy": "few_shot", "dialect": "B", "system": SYSTEM_B, "examples": EXAMPLES_FEW_SHOT, "max_tokens": 800},
]

STRATEGY_NAMES = [s["strategy"] for s in STRATEGIES]


def strategies(names: list[str] | None = None) -> list[dict]:
    """The strategy rows, optionally restricted to ``names`` (in that order)."""
    if names is None:
        return list(STRATEGIES)
    by_name = {s["strategy"]: s for s in STRATEGIES}
    unknown = [n for n in names if n not in by_name]
    if unknown:
        raise ValueError(f"unknown strategies: {unknown}")
    return [by_name[n] for n in names]
