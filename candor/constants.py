"""Fixed values.

Everything below must stay exactly as written: validation messages, prompt texts, decoding
parameter sets and report sentences are part of the observable output. They are stated here
once, in their natural order, and imported everywhere else.
"""

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — character classes and patterns
# ---------------------------------------------------------------------------------------------

# The 29 code points that Python's str.split()/str.strip() treat as whitespace. The same class
# text works in Java regex (Spark) and RE2 (DuckDB).
WS_CLASS = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # the same, one by one
NON_WS_CLASS = (
    r"[^\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Regex word (a run of word characters, apostrophes and hyphens holding one word character).
REGEX_WORD = r"[\p{L}\p{N}_'-]*[\p{L}\p{N}_][\p{L}\p{N}_'-]*"
# Sentence terminator characters.
TERMINATOR = r"[.!?]"
TERMINATOR_RUN = r"[.!?]+"
# Physical line breaks of a text (as Python text mode).
LINE_BREAK = r"\r\n|\r|\n"
# Echoed summarize instruction removed before taking the first sentence.
ECHO_PATTERN = r"(?iu)summarize.*?: *[“\"”]?"
# Sentence split used by the first-sentence post-processing.
SENTENCE_SPLIT = r"[.!?] +"
# Characters stripped from both ends of the first sentence.
QUOTE_STRIP = " \"'“”"

# Word window (inclusive).
WORD_LOW = 8
WORD_HIGH = 24
# Neutral band default and centre.
NEUTRAL_BAND = 0.10
NEUTRAL_CENTRE = 0.5
# Preview length of the per-line report.
PREVIEW_CHARS = 120

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — validation messages
# ---------------------------------------------------------------------------------------------

MSG_NO_PERIOD = "no period"
MSG_MULTI = ">1 sentence or punctuation"
MSG_TOO_SHORT = "too short"
MSG_TOO_LONG = "too long"
MSG_UNCHANGED = "unchanged"
NOTES_SEP = "; "

# Single-rewrite check messages (the word count message carries the count).
MSG_SINGLE_PERIOD = "constraint not satisfied: output must end with a period."
MSG_SINGLE_ONE = "constraint not satisfied: output must be exactly one sentence (no '?' or '!' or multiple sentences)."
MSG_SINGLE_WORDS = "constraint not satisfied: output must be 8–24 words (got %d)."

# Failure-reason messages, joined with ", "; "passes" when none applies.
REASON_MULTI = "more than one sentence"
REASON_NO_PERIOD = "missing final period"
REASON_WORDS = "word count %d outside 8–24"
REASON_REPEAT = "repetition detected"
REASON_SEP = ", "
REASON_NONE = "passes"

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — prompt templates: (name, text before the line, text after the line)
# ---------------------------------------------------------------------------------------------

TEMPLATES = [
    (
        "simple",
        "Rewrite the sentence in simpler English. "
        "Output exactly one sentence, 8 to 24 words, ending with a period.\n\nSentence: ",
        "",
    ),
    (
        "simplified",
        "Rewrite the sentence using simpler English and different wording. "
        "Do not copy the original sentence; rephrase it with simpler words. "
        "Output exactly one sentence, 8 to 24 words, ending with a period.\n\nOriginal: ",
        "\nSimplified:",
    ),
    (
        "paraphrase",
        "Paraphrase the sentence using simpler English and different wording. "
        "Do NOT repeat any phrase longer than 3 words from the original. "
        "Keep the same meaning. Output exactly one sentence, 8–24 words, ending with a period.\n\nSentence: \"",
        "\"",
    ),
    (
        "summarize",
        "Summarize the following in exactly one sentence ending with a period:\n\n",
        "",
    ),
]
BATCH_PREFIX = "Respond in one sentence: "

# The 12-prompt study set: (family, prompt).
PROMPT_SET = [
    ("rewrite", "Rewrite the sentence in simpler English. End with a period. Sentence: 'Python’s clear syntax helps beginners focus on problem-solving.' Output:"),
    ("rewrite", "Rewrite the sentence in simpler English. End with a period. Sentence: 'Version control lets teams track changes and work safely together.' Output:"),
    ("rewrite", "Rewrite the sentence in simpler English. End with a period. Sentence: 'Preprocessing text often includes lowercasing and removing extra spaces.' Output:"),
    ("rewrite", "Rewrite the sentence in simpler English. End with a period. Sentence: 'Short prompts run faster on CPU because attention scales with length.' Output:"),
    ("explain", "Explain in one sentence what a learning rate does. End with a period."),
    ("explain", "Explain in one sentence what an API key is used for. End with a period."),
    ("explain", "Explain in one sentence what a unit test checks. End with a period."),
    ("explain", "Explain in one sentence what a tokenizer does in NLP. End with a period."),
    ("summarize", "Summarize in one sentence: 'Pipelines bundle tokenization, the model, and decoding. They are great for quick demos on CPU.' Output:"),
    ("summarize", "Summarize in one sentence: 'Batching several prompts can improve throughput. Padding and masks keep shapes compatible.' Output:"),
    ("summarize", "Summarize in one sentence: 'Beam search is deterministic and often fluent. Sampling adds creativity but may drift.' Output:"),
    ("summarize", "Summarize in one sentence: 'SentencePiece and WordPiece split text into subwords. This keeps vocabulary small and improves coverage.' Output:"),
]

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — decoding strategies
# (strategy, do_sample, num_beams, temperature, top_p, top_k, no_repeat_ngram,
#  source_no_repeat_ngram, repetition_penalty, length_penalty, min_length, max_length)
# ---------------------------------------------------------------------------------------------

STRATEGY_COLUMNS = [
    "strategy", "do_sample", "num_beams", "temperature", "top_p", "top_k", "no_repeat_ngram",
    "source_no_repeat_ngram", "repetition_penalty", "length_penalty", "min_length", "max_length",
]
STRATEGIES = {
    # notebook study
    "greedy": ("greedy", False, 1, None, None, None, None, None, None, None, None, 32),
    "beam": ("beam", False, 5, None, None, None, None, None, None, None, None, 32),
    "sampling": ("sampling", True, None, 0.8, 0.9, None, None, None, None, None, None, 32),
    # batch rewrite with CSV export
    "rewrite_beam": ("beam", False, 4, None, None, None, 2, None, None, None, None, 48),
    "rewrite_sampling": ("sampling", True, None, 0.7, 0.95, 50, None, None, None, None, None, 48),
    # guarded summarize
    "summary_beam": ("beam", False, 4, None, None, None, 3, 4, None, 2.0, 10, 20),
    "summary_sampling": ("sampling", True, None, 1.0, 0.92, 50, 3, 4, None, 2.0, 10, 20),
    "summary_retry": ("retry", True, None, 1.1, 0.90, 50, 3, 4, None, 2.0, 10, 20),
    # guarded rewrite
    "guarded_beam": ("beam", False, 6, None, None, None, 3, 4, 1.1, None, None, 64),
    "guarded_sampling": ("sampling", True, None, 0.9, 0.95, 50, 3, 4, 1.15, None, None, 64),
    "guarded_retry": ("retry", True, None, 1.2, 0.92, 40, 3, 4, 1.2, None, None, 64),
}
DEFAULT_SEED = 42

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — report sentences and labels
# ---------------------------------------------------------------------------------------------

REFLECTION_BEAM = "Beam search gives more control and passes constraints more often, but can sound stiff."
REFLECTION_SAMPLING = "Sampling sounds more varied, but fails constraints more often due to randomness."
NO_ROWS = "No rows."
ALL_PASSED = "(all passed)"
LABEL_POSITIVE = "POSITIVE"
LABEL_NEGATIVE = "NEGATIVE"
LABEL_NEUTRAL = "NEUTRAL"

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — columns of the candidate CSV, in order
# ---------------------------------------------------------------------------------------------

CSV_COLUMNS = ["input", "output", "decoding", "tokens_out", "constraint_passed", "notes"]

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — report lines (printf formats)
# ---------------------------------------------------------------------------------------------

SENTIMENT_LINE = "%02d. raw=%s (%.3f) -> neutralized=%s"
SENTIMENT_TEXT_LINE = "    text: %s"
SIDE_BY_SIDE = ["%02d. [Greedy] %s", "    [Beam]   %s", "    [Sample] %s"]
STRATEGY_HEADER = "Strategy    Pass%  AvgWC  StdWC  Repeat%"
STRATEGY_LINE = "%-10s %6.1f %6.1f %6.1f %8.1f"
MINI_REPORT = ["=== Mini-report: %s ===", "Rows: %d", "Constraint pass rate: %.1f%%", "Average tokens_out: %.2f", "Reflection: %s"]
MINI_REPORT_EMPTY = "[%s] No rows."
# (metric column, line)
GUARD_METRICS = [
    ("beam_pass_pct", "Beam pass-rate       : %.1f%%"),
    ("sampling_pass_pct", "Sampling pass-rate   : %.1f%%"),
    ("avg_words_beam", "Avg length — beam    : %.2f words"),
    ("avg_words_sampling", "Avg length — sampling: %.2f words"),
    ("retry_triggered", "Retry triggered      : %d case(s)"),
    ("retry_fix_pct", "Retry fix-rate       : %.1f%%"),
]
RAW_DISTRIBUTION = "Raw distribution        : POS=%d, NEG=%d"
NEUTRAL_DISTRIBUTION = "Neutralized distribution: POS=%d, NEG=%d, NEU=%d"
