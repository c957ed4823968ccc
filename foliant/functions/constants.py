"""Fixed values of the text rules, as plain lists."""

# Stop words of the tokenizer, English then Russian.
STOP_WORDS = """a an the and or for to of in on at by as is are was were be been being
this that those these with from into over under about across between
among through during before after above below not no nor so such it
its their our your my we you they he she his her them us
и в во не на но а к ко от до по за из у о об при над под для без
между как так же уже ещё еще или либо это эти эта этот кто что где
когда чем чтобы который которая которые бы то все всё""".split()

# Substrings that mark source code.
CODE_MARKS = ["```", "def ", "class ", "function ", "import ", "const ", "var ", "let ", "=>", "public class", "private "]
# Characters that mark a formula.
FORMULA_MARKS = ["=", "∑", "∫", "√", "±", "×", "÷", "∂", "∆", "≈", "≤", "≥"]
# Words that mark a figure.
DIAGRAM_MARKS = ["Figure", "Fig.", "Diagram", "Chart", "Graph", "Illustration"]
# Patterns of citations.
CITATIONS = [r"\[\d+\]", r"\([A-Z][a-z]+\s+\d{4}\)", r"\[[A-Z][a-z]+\d{4}\]"]
# Fixed value: the pattern of a simple formula.
FORMULA = r"[a-zA-Z]\s*[=+\-*/]\s*[a-zA-Z0-9]|[a-zA-Z][²³⁴]"

# Chapter and section headings, tried in this order.
CHAPTERS = [
    r"(?i)^\s*Chapter\s+(\d+|[IVXLCDM]+)\s*[:\-\.]?\s*(.*)$",
    r"(?i)^\s*Ch\.\s*(\d+)\s*[:\-\.]?\s*(.*)$",
    r"(?i)^\s*Глава\s+(\d+|[IVXLCDM]+)\s*[:\-\.]?\s*(.*)$",
]
SECTIONS = [
    r"^\s*(\d+\.\d+(?:\.\d+)?)\s+(.+)$",
    r"^\s*Section\s+(\d+|[A-Z])\s*[:\-\.]?\s*(.*)$",
    r"^\s*§\s*(\d+)\s*[:\-\.]?\s*(.*)$",
]
# What a table of contents says.
CONTENTS_MARKS = ["table of contents", "contents", "содержание", "оглавление"]

# Lines that hold a page number only.
PAGE_NUMBERS = [r"^\s*\d+\s*$", r"^\s*-\s*\d+\s*-\s*$", r"^\s*\[\s*\d+\s*\]\s*$"]
# Marks that e-book sites leave in texts.
WATERMARKS = [r"(?i)\s*oceanofpdf\.com\s*", r"(?i)\s*generated\s+by\s+", r"(?i)\s*downloaded\s+from\s+", r"(?i)\s*www\.[a-z0-9\-]+\.(com|org|net)\s*"]

# Characters that are replaced when text is normalised.
REMOVED = "\u0000\ufeff\u00ad\u200b\u200c\u200d"
REPLACED = {"«": '"', "»": '"', "‹": "'", "›": "'", "–": "--", "—": "---", "−": "-", "‐": "-"}

# File-name characters that are unsafe, and what stands for them.
UNSAFE = {
    "®": "r", "©": "c", "™": "tm", "°": "deg", "±": "pm", "×": "x", "÷": "div", "€": "eur", "£": "gbp", "¥": "yen", "§": "s", "¶": "p",
    "†": "+", "‡": "++", "•": "-", "…": "...", "<": "_", ">": "_", ":": "_", '"': "_", "/": "_", "\\": "_", "|": "_", "?": "_", "*": "_",
}
# Latin letters for Cyrillic ones.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}

# Search terms and what they are widened to, in this order.
SYNONYMS = {
    "deploy": ["deployment", "release", "rollout"],
    "monitor": ["monitoring", "observability", "telemetry"],
    "ci": ["continuous integration", "build automation"],
    "cd": ["continuous delivery", "continuous deployment"],
    "devops": ["site reliability", "sre", "platform engineering"],
    "architecture": ["design", "system design", "infrastructure"],
    "microservice": ["microservices", "service-oriented"],
    "container": ["docker", "kubernetes", "containerization"],
    "test": ["testing", "qa", "quality assurance"],
    "agile": ["scrum", "kanban", "sprint"],
}

# Quality limits by stage; min_x and max_x bound the metric x.
THRESHOLDS = {
    "structural": {"min_success_ratio": 0.95, "max_empty_ratio": 0.10, "min_avg_page_length": 500, "max_error_ratio": 0.05, "max_ocr_ratio": 0.20},
    "structure_detect": {"min_chapters_detected": 1, "min_toc_coverage": 0.80, "max_orphan_pages": 0.15},
    "summarize": {"min_summary_ratio": 0.90, "min_summary_length": 100, "max_summary_length": 400},
    "extended": {"max_duplicates_ratio": 0.05, "min_extended_fields_ratio": 0.70, "min_topics_per_page": 1, "min_lm_extraction_ratio": 0.80, "max_continuity_gaps": 0.10},
    "finalize": {"min_validation_pass_rate": 0.99, "max_policy_violations": 0.01},
    "chunk": {"min_chunks_per_page": 1, "max_chunks_per_page": 20, "min_chunk_length": 100, "max_chunk_length": 2000, "min_avg_tokens": 50, "max_avg_tokens": 600},
    "embed": {"min_embedding_success": 0.99, "max_embedding_time_per_chunk": 0.5},
}
