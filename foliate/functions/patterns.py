"""Patterns and lists that decide results.

Fixed values: they define the document format that is parsed and must stay as
they are.  They use what Java's and RE2's expressions have in common, so the
same text serves Spark and the SQL that checks it.
"""

#: Java's white space in its Unicode classes; `btrim` with it is what `^\s+|\s+$` removes.
WHITE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

# --- fixed values: page and block markup -------------------------------------
PAGE_NUMBER = r"(?i)<!--\s*PageNumber:\s*(\d+)\s*-->"
PAGE_BREAK = r"(?i)<!--\s*PageBreak\s*-->"
MARKER_PAGE = r"(?i)^\s*\{?\s*PAGE\s*_?\s*NUMBER\s*:?\s*(\d+)\s*\}?\s*$"
IMAGE_REF = r"!\[[^\]]*\]\([^)]+\)"
IMAGE_PATH = r"!\[[^\]]*\]\(([^)]+)\)"
HEADING = r"^#{1,6}\s+"
TABLE_ROW = r"^\s*\|"
MATH = r"^\s*\$\$"
TABLE_SEPARATOR = r"^:?-{3,}:?$"
BR_TAG = r"(?i)<br\s*/?>"
LIST_PREFIX = r"^[-*+]\s+"
BOLD = r"\*\*([^*]+)\*\*"

# --- fixed values: questions --------------------------------------------------
ANCHOR_PREFIXED = (
    r"(?i)^Q\s*(\d+)\s*[\.\):\-]",
    r"(?i)^Q\s*\.\s*(\d+)",
    r"(?i)^Question\s+(?:No\.?\s*)?(\d+)",
    r"(?i)^Que\.?\s*(\d+)",
)
ANCHOR_NUMERIC = (
    r"(?s)^(\d+)\.\s+(.+)$",
    r"(?s)^(\d+)\)\s+(.+)$",
    r"(?s)^\((\d+)\)\s+(.+)$",
)
ANSWER_LIKE = r"^[A-Da-d]\s*[\.\)]?\s*$"
OPTION_PAREN = r"(?s)^\s*\(([A-Da-d])\)\s*(.*)$"
OPTION_CLOSE = r"(?s)^\s*([A-Da-d])\)\s*(.*)$"
OPTION_DOT = r"(?s)^([A-D])\.\s*(.*)$"
PARSED_PAREN = r"(?s)^\s*\(([A-Ea-e])\)\s*(.*)$"
PARSED_DOT = r"(?s)^([A-E])\.\s*(.*)$"
EMBEDDED_MARKER = r"\s+\(([A-Ea-e])\)\s*"
BOLD_OPTION = r"^[-*+]\s+\*\*([A-Da-d])\*\*\s+(.+)$"

# --- fixed values: answers and solutions ----------------------------------------
SOLUTION_HEADING = r"(?i)^#{0,6}\s*(Solutions?|Answer\s*Key|Answers?\s*(?:Key|Sheet)?|Answer\s*Sheet)\s*:?\s*$"
#: The mapper's own heading, which also knows explanations.
MAPPED_HEADING = r"(?i)^#{0,6}\s*(Solutions?|Answer\s*Key|Answers?\s*(?:Key|Sheet)?|Answer\s*Sheet|Explanations?)\s*:?\s*$"
SOLUTION_ANCHOR = r"(?i)^S\s*(\d+)\s*[\.\):\-]"
ANSWER_MARKER = r"(?i)\bAns(?:wer)?\s*[\.\:]?\s*\(?\s*([A-Da-d])\s*\)?"
ANSWER_FORMS = (
    (r"(?i)^S\s*(\d+)\s*[\.\):\-]?\s*Ans(?:wer)?\s*[\.\:]*\s*\(\s*([A-Ea-e])\s*\)", 0.95),
    (r"(?i)^S\s*(\d+)\s*[\.\):\-]?\s*Ans(?:wer)?\s*[\.\:]*\s*([A-Ea-e])\b", 0.9),
    (r"(?i)^Q\s*(\d+)\s*Answer\s*:\s*([A-Ea-e])\b", 0.9),
    (r"(?i)^Q\s*(\d+)\s*[\.\):\-]?\s*Ans(?:wer)?\s*[\.\:]*\s*([A-Ea-e])\b", 0.85),
)
COMPACT_KEY = r"^(\d+)\s*[\.\)\-]\s*([A-Ea-e])\b"
KEY_NUMERIC = r"(?i)^(\d+)\s*[\.\)]\s*([A-Da-d])\s*\.?\s*$"
KEY_INLINE = r"(?i)^(\d+)\s*[\.\)]\s+([A-Da-d])\b"
KEY_BARE = r"(?i)^\d{1,3}\s*\.\s*[A-Da-d]\s*\.?$"
#: Words that mark a question even in a table.
ASKING = r"(?i)\b(select|which|what|who|how|find|identify|arrange|evaluate)\b"
KEY_PAIR = r"(\d{1,3})\s*\.\s*([A-Da-d])\b"

# --- fixed values: notices and metadata -------------------------------------------
METADATA = r"(?i)^(?:Exam(?:ination)?|Subject|Paper|Year|Set|Code)\s*[:\-]"
METADATA_EXAM = r"(?i)(?:SSC\s*CGL|CGL|Tier\s*\d+|Shift\s*\d+|Exam\s*Date|General\s+Awareness|Quantitative|Reasoning|English)"
FOOTER = r"(?i)(?:www\.|http://|https://|©|copyright|all rights reserved|visit us at)"
SECTION_HEADING = r"^#{1,6}\s+.+"
INSTRUCTION = r"(?i)^(?:Directions?|Instructions?|Read the following|Note\s*:)\b"
ADVERTISEMENT = r"(?i)(?:Free\s+Mock\s+Test|Previous\s+Papers?|Subscribe\s+Now|Buy\s+Now|Download\s+PDF|Get\s+Free|Join\s+Telegram|Visit\s+our\s+website)"
DOWNLOAD = r"(?i)(?:www\.|http://|https://|\.pdf\b)"
VISUAL_PHRASES = (
    "following figure", "given figure", "figure series", "embedded figure", "figure is embedded", "mirror image", "dice", "cube",
    "rotated positions", "paper folding", "water image", "how many triangles", "how many squares", "figure shown", "same dice",
    "positions of the same dice", "select the option in which", "select the figure", "select the correct mirror", "select the term",
    "diagram", "shape",
)

# --- fixed values: option keys ------------------------------------------------------
KEY_FORMS = (
    r"^[-*+]\s+\*\*?([A-Da-d])\*\*?\s*$",
    r"^\*\*?([A-Da-d])\*\*?\.?$",
    r"^\(?\s*([A-Da-d])\s*\)?\.?$",
    r"^([A-Da-d])\.\s*$",
    r"^[-*+]\s+\*\*?([A-Da-d])\*\*?",
)
ANSWER_PREFIX = r"(?i)^(?:ans(?:wer)?|key)\s*[\.\(]?\s*\(?\s*([A-Da-d])\s*\)?\.?$"
OPTION_WORD = r"(?i)^option\s+"
LOOK_ALIKES = ("ΑАΒВСΔ", "AABBCD")

# --- fixed values: block types by line type -----------------------------------------
BLOCK_TYPES = {
    "blank": "text_block",
    "heading": "heading_block",
    "page_number_marker": "page_marker_block",
    "page_footer_marker": "noise_block",
    "page_break_marker": "page_marker_block",
    "question_anchor": "question_candidate_block",
    "option_candidate": "option_candidate_block",
    "solution_section_heading": "solution_candidate_block",
    "solution_anchor": "solution_candidate_block",
    "answer_marker": "solution_candidate_block",
    "image_reference": "image_block",
    "table_row": "table_block",
    "math_block": "math_block",
    "metadata_candidate": "text_block",
    "noise_candidate": "noise_block",
    "text": "text_block",
}

# --- fixed values: sections of evidence --------------------------------------------
SECTION_SOLUTION = r"(?i)^(?:#{1,6}\s*)?(?:\*\*)?\s*(solutions?|answers?(?:\s*key)?|answer\s*key|answer\s*sheet|explanations?|detailed\s+solutions?|answers?\s+with\s+explanations?)\s*:?\s*(?:\*\*)?\s*$"
SECTION_KEY = r"(?i)^(?:#{1,6}\s*)?(?:\*\*)?\s*answer\s*key\s*(?:\*\*)?\s*$"
OTHER_HEADING = r"(?i)\b(?:directions?|instructions?|questions?\s+paper|practice\s+questions?|quantitative\s+aptitude|general\s+awareness|english\s+language|reasoning|syllabus|index|contents?|topic|chapter)\b"
SECTION_NOISE = r"(?i)(?:free\s+mock|download\s+pdf|subscribe\s+now|previous\s+papers?)"
SOLUTION_NAMES = ("explanations", "explanation", "solutions", "solution", "answers", "answerkey", "answerswithexplanations", "answerwithexplanations", "detailedsolution", "detailedsolutions")
STRONG_NAMES = ("answerskey",)
NUMBER_PREFIX = r"(?i)^(?:Q\.?\s*)?(\d{1,3})\s*[\.\)]\s*\*{0,2}\s*"
SOLUTION_START = r"(?i)^(?:\|?\s*)?(?:\*\*)?\s*(?:Q\.?\s*)?(\d{1,3})\s*[\.\)]\s*(?:\*\*)?\s*(?:Ans(?:wer)?[\.\:]?\s*)?(?:\(\s*\*?([A-Ea-e])\s*\*?\s*\)|([A-Ea-e])\s*[\)\.:]|Answer\s*:\s*([A-Ea-e])\b)"

# --- fixed values: anchors and lines of question windows ------------------------------
WINDOW_ANCHOR = r"(?i)^(?:\|+\s*)*(?:[-•*]\s*)?(?:\*\*)?(?:Q\.?\s*)?(\d{1,3})\s*[\.\)]"
INLINE_ANCHOR = r"(?i)\bQ\.?\s*(\d{1,3})\b"
LETTER_ANCHOR = r"(?i)\bQ\.?\s*\d"
STRONG_ANCHOR = r"(?i)^(?:\|+\s*)*(?:[-•*]\s*)?(?:\*\*)?\s*(?:Q\.?\s*)?\d{1,3}\s*[\.\)]\s+\S"
EXPLICIT_ANCHOR = r"(?i)^(?:\|+\s*)*(?:[-•*]\s*)?(?:\*\*)?\s*Q\.?\s*(\d{1,3})\b"
PIPE_ANCHOR = r"(?i)^\|\s*Q\.?\s*(\d{1,3})\s*\|"
BARE_OPTION = r"(?i)^(?:\d+\.\s*\d|\(\*?[A-Ea-e]\*?\)\s*|\([A-Ea-e]\)\s*|\d+\.\s+[A-Za-z]{1,25}$)"
ANCHOR_INSTRUCTION = r"(?i)^\s*(?:[-•*]\s*)?(?:\*\*)?\s*\d{1,3}\s*[\.\)]\s+.*(?:options?\s+shown|tick\s+icon|correct\s+answer\s+will|incorrect\s+answer\s+will|negative\s+mark)"
KEY_ANCHOR = r"(?i)^(?:\|+\s*)?(?:[-•*]\s*)?(?:\*\*)?(?:Q\.?\s*)?(\d{1,3})\s*[\.\)]\s*(.*)$"
KEY_REST = r"(?i)^[A-D]\s*(?:\|.*)?$"
WINDOW_NOISE = r"(?i)(?:free\s+mock|download\s+pdf|www\.|subscribe\s+now|previous\s+papers?|all\s+exams|one\s+subscription|attempt\s+free\s+mock|personalised\s+report|unlimited\s+re-?attempt|exam\s+covered|refund|mock\s+tests?)"
WINDOW_OPTION = r"(?i)(?:^|\s|>|-\s*)(?:(\d+)\s*[\.\)]\s*\S|\(\*?[A-Da-d]\*?\)\s*\S|[A-Da-d]\.\s+\S)"
WINDOW_LABELS = (r"(?:^|\s)(\d)\s*[\.\)]\s*\S", r"\(\*?([A-Da-d])\*?\)\s*\S", r"(?:^|\s|-\s*)([A-Da-d])\.\s+\S")
NUMBERED_ANSWER = r"(?i)\bans\s*\d"
STATUS_LINE = r"(?i)status\s*:"
QUESTION_ID = r"(?i)question\s*id"
SOLUTION_NUMBER = r"(?i)^(?:\|?\s*)?(?:\*\*)?\s*(?:Q\.?\s*)?(\d{1,3})\s*[\.\)]"
SOLUTION_LABEL = r"(?i)(?:Ans(?:wer)?[\.\:]?\s*)?(?:\(\s*\*?([A-Ea-e])\s*\*?\s*\)|([A-Ea-e])\s*[\)\.:]|Answer\s*:\s*([A-Ea-e])\b)"
SOLUTION_NOISE = r"(?i)(?:free\s+mock|download\s+pdf|www\.|subscribe\s+now)"

#: What every line has that a predicate of the same name holds for: one pattern that ends early on the other lines.
ANCHOR_GUARD = r"^\s*+(?:\|++\s*+)*+(?:[-•*]\s*+)?(?:\*\*)?\s*+(?:[Qq]\.?\s*+)?\d{1,3}\s*+[\.\)]|[Qq]\.?+\s*+\d"
HEADING_GUARD = r"(?i)^[*#_\s]*+(?:s[*#_\s]*+o|a[*#_\s]*+n|e[*#_\s]*+x|d[*#_\s]*+e)"
START_GUARD = r"(?i)^[\s|*\-•Q.]*+\d"
KEY_ROW_GUARD = r"\.(?<=[\d\s]\.)\s*+[A-Da-d]"
DIGIT = r"\d"
LABEL_GUARD = r"\d\s*+[\.\)]|\(\*?[A-Da-d]\*?\)|(?:^|[\s-])[A-Da-d]\."
CHOSEN_GUARD = r"(?i)chosen\s+option"
#: These look behind a character that few places have, so that other places cost one test.  ſ, ı and İ are what patterns without regard to case take for s and i.
FOOTER_GUARD = r"[wWhHpPvV©](?:(?<=©)|(?<=[wW])[wW]|(?<=[hH])[tT][tT][pP]|(?<=[pP])[yY][rR]|(?<=[vV])(?:[iIıİ][sSſ][iIıİ][tT]|[eE][dD]))"
NOISE_GUARD = r"[mMwWbBpPxXfF](?:(?<=[mM])(?:[oO][cC]|[pP][tT])|(?<=[wW])(?:[wW]|[nN][lL])|(?<=[bB])[sSſ][cC]|(?<=[pP])(?:[rR][eE][vV]|[oO][rR][tT])|(?<=[xX])[aA][mM]|(?<=[fF])[uU][nN][dD])"
OPTION_GUARD = r"[\d\.\)](?:(?<=[\d\s*][\.\)])|(?<=[(*][A-Da-d]\))|(?<=[\s>-][A-Da-d]\.)|(?<=^[A-Da-d]\.)|(?<=[nN][sSſ]\d)|(?<=[nN][sSſ]\s\d)|(?<=\s\s\d))"
STATUS_GUARD = r"[:qQ](?:(?<=[sSſ\s]:)|(?<=[qQ])[uU][eE])"
#: For each of WINDOW_LABELS.
LABEL_GUARDS = (r"[\.\)](?<=[\d\s][\.\)])", r"\)(?<=[A-Da-d*]\))", r"\.(?:(?<=[\s-][A-Da-d]\.)|(?<=^[A-Da-d]\.))")
#: How a question's label begins, and what a text without list, bold or heading marks lacks.
QUESTION_LEAD = r"^(?:[Qq]|\(?\d)"
MARK_LEAD = r"^[-*+#]"
DOT_LABEL = r"(?:^|\s)[A-Da-d]\."
NUMBER_LABEL = r"\d\s*+[\.\)]"
#: Over lower-case text; texts with a letter of FOLDED, which a pattern takes for an s or i, are asked always.
OPTION_NOISE_GUARD = r"mock|download|www\.|subscri|exams|report|unlimited|covered|refund"
FOLDED = "[ſıİ]"

# --- fixed values: families of options inside one line (rows 201-207) ---------------------------
LINE_BULLET = r"^[-•]\s+"
ANCHOR_STRIP = r"(?i)^(?:[-•*]\s*)?(?:\*\*)?(?:Q\.?\s*)?\d{1,3}\s*[\.\)]\s*(?:\*\*)?\s*"
FIRST_MARKER = r"(?i)(?:\(\*?[A-Da-d]\*?\)|\([A-Da-d]\)|(?:^|\s)[A-Da-d]\.\s|(?:^|\s)[1-4]\s*[\.\)]\s|(?:^|\s)(?:Ans(?:wer)?\s*)?[1-4]\s*[\.\)])"
PIPE_TABLE_OPTION = r"^(?:\|+\s*)+([A-Da-d])\s{2,}(.+?)\s*\|?\s*$"
MATHSF_OPTION = r"(?i)\\mathsf\{([A-Da-d])\}"
EXPLICIT_LABELS = (r"\*\*[A-Da-d]\*\*", r"\([A-Da-d]\)", r"\(\*?[A-Da-d]\*?\)", r"(?:^|\s)[A-Da-d]\.")
#: Several options in one line, each text up to the next marker of its family.
SEVERAL = (
    r"\(\*?([A-Da-d])\*?\)\s*([^(*]+?)(?=\s*\(\*?[A-Da-d]\*?\)|$)",
    r"[-*+]\s+\*\*([A-Da-d])\*\*\s*([^-*]+?)(?=(?:\s*[-*+]\s+\*\*[A-Da-d]\*\*)|$)",
    r"\*\*([A-Da-d])\*\*\s*([^*]+?)(?=\s*\*\*[A-Da-d]\*\*|$)",
    r"\(([A-Da-d])\)\s*([^()]+?)(?=\s*\([A-Da-d]\)|$)",
    r"(?:^|\s)([A-Da-d])\.\s+([^A-D.]+?)(?=(?:\s+[A-D]\.)|$)",
)
SEVERAL_NUMERIC = r"(?i)(?:Ans(?:wer)?\s*)?(\d+)\s*[\.\)]\s*([^0-9]+?)(?=(?:\s*(?:Ans(?:wer)?\s*)?\d+\s*[\.\)])|$)"
#: One option a line, in the order of trial.
SINGLE = (
    r"(?i)^[✓✔√×xX★🔀\s]*(?:<[^>]+>)*\s*([A-Da-d])\.\s*(.+)$",
    r"^[-*+]\s+\*\*([A-Da-d])\*\*\s+(.+)$",
    r"^\*\*?([A-Da-d])\*\*?\s+(.+)$",
    r"^[-*+]\s+\(\*?([A-Da-d])\*?\)\s*(.+)$",
    r"^[-*+]\s+([A-Da-d])\s+(.+)$",
    r"^\s*\(\*?([A-Da-d])\*?\)\s*(.+)$",
    r"^([A-Da-d])\.\s+(.+)$",
    r"^([A-Da-d])\s+(.+)$",
)
TABLE_OPTION = r"^\|?\s*\|?\s*([^\s|])\s*\|\s*(.+?)\s*\|?\s*$"
PAREN_LABEL = r"\(\*?([A-Da-d])\*?\)"
OPTION_NOISE = r"(?i)(?:free\s+mock|download\s+pdf|www\.|subscribe\s+now|all\s+exams|one\s+subscription|attempt\s+free\s+mock|personalised\s+report|unlimited\s+re-?attempt|exam\s+covered|refund)"
BOLD_OPTION_LINE = r"^\*\*([A-Da-d])\*\*"
ANCHOR_LOOK = r"^(?:[-•*]|\*\*|[Qq]\.?\s*\d)"
MATCHED_ANYWHERE = r"\([*A-Da-d]|\*[A-Da-d]\*|[A-Da-d]\.|^[^\w|]*[A-Da-d]\s|\||\\mathsf|\d\s*[\.\)]"

# --- fixed values: question numbers at which a block of a window begins (rows 131, 132) ----------------
BLOCK_ANCHOR = r"^(?:[-*+]\s+)?(?:\|\s*)?(?:\*\*)?(\d{1,3})\.(?:\*\*)?\s*(?:\|\s*)?"
BOLD_ANCHOR = r"\*\*(\d{1,3})\.\*\*"
#: Where else, in the first characters of a line, its question's number may stand.
NUMBER_PLACES = (r"^(?:[-*+]\s+)?\*\*(\d+)\.", r"^(\d+)\.\s", r"^\|\s*(\d+)\.", r"^(\d+)\s*\|\s*", r"\*\*(\d+)\.\*\*")
