"""Fixed texts and defaults. Outputs depend on them character by character."""

# --- Fixed values: prompts, markers, tags -----------------------------------------------------
SYSTEM_PROMPT = (
    "You are an expert in summarizing texts. Extract and present the main key point of the input "
    "text in one short sentence, including essential details like dates, locations, persons and "
    "organizations if necessary."
)
INSTRUCTION = (
    "Write one sentence that summarizes this conversation, emphasizing any meetings, persons or "
    "places mentioned in the conversation."
)
DIALOG_SEPARATOR = "\n\n **Conversation:** \n\n"
PROMPT_PREFIX = f"{INSTRUCTION} {DIALOG_SEPARATOR} "
PROMPT_PREFIX_ONE_LINE = f"{INSTRUCTION} **Conversation:** "
SUMMARY_MARKER = "**Summary"
MARKUP_CHARS = "\n*:"
OUTPUT_COLUMN_PREFIX = "summary_by_"
SCORE_COLUMN_PREFIX = "rougeL_score_"
ENTITY_TYPES = ("PER", "ORG", "LOC")
TRAINING_COLUMNS = ("system_prompt", "dialog", "summary")
OUTPUT_ID_COLUMNS = ("summary", "dialog", "system_prompt", "messages", "text", "prompt")

# --- Fixed values: workload sizes and seed ----------------------------------------------------
SHUFFLE_SEED = 90201
TEST_FRACTION = 0.05
EVAL_SUBSET_ROWS = 5_000
HOLDOUT_ROWS = 10_000
HUMAN_SAMPLE_ROWS = 100
BALLOTS_READ = 50
READING_SAMPLE_ROWS = 20

# --- Fixed values: the code points Python's str.strip() removes -------------------------------
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same code points inside a regex class; valid in Java and in RE2.
PY_WHITESPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPEAKER_TAG_PATTERN = r"#Person\p{Nd}+#[:" + PY_WHITESPACE_CLASS + "]*"
