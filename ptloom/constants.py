"""Fixed values that must equal the reference's for equal results.

Fixed values: prompts, tool registry, rejected-answer texts, role names,
classifier labels and score weights, stated plainly and in natural order.
"""

# --- fixed values: preference builder -------------------------------------
PREFERENCE_SYSTEM_PROMPT = (
    "You are a helpful assistant that outputs only valid JSON tool calls. "
    "Do not include any explanation or extra text. "
    "Always respond with a single JSON object in the format: "
    '{"tool": "<tool_name>", "arguments": {<key>: <value>}}'
)

# tool name, description, argument keys
TOOLS = [
    ("calculator", "Evaluates a mathematical expression.", ["expression"]),
    ("weather", "Gets the current weather for a city.", ["city"]),
    ("translate", "Translates text from one language to another.", ["text"]),
    ("search", "Searches the web for a query.", ["query"]),
    ("unit_convert", "Converts a value from one unit to another.", ["value", "from_unit", "to_unit"]),
]
TOOL_NAMES = [t[0] for t in TOOLS]

REJECT_PROSE_TEMPLATE = "I will calculate this for you. The answer is approximately %d."
REJECT_EXTRA_TEXT_PREFIX = "Sure! I can help with that. Here is the tool call you need:\n"
REJECT_EXTRA_TEXT_SUFFIX = "\nHope that helps!"
RANDOM_INT_LOW, RANDOM_INT_HIGH = 1, 9999
N_REJECTED_VARIANTS = 6
PREFERENCE_VAL_RATIO = 0.1
SEED = 42

# --- fixed values: SFT chat builder ---------------------------------------
SFT_SYSTEM_PROMPT = "You are a careful tool-use assistant."
SFT_CALC_USER_TEMPLATE = "Use a tool to calculate: "
SFT_JSON_USER_TEMPLATE = "Validate whether this text is JSON: "
SFT_CALC_ID_FORMAT = "sft_calc_%03d"
SFT_JSON_ID_FORMAT = "sft_json_%03d"
CHAT_VAL_RATIO = 0.2

# --- fixed values: validation and classification --------------------------
ALLOWED_ROLES = ["system", "user", "assistant"]
REJECTED_TYPES = [
    "non_json",
    "invalid_json",
    "wrong_key_name",
    "empty_arguments",
    "wrong_tool_name",
    "extra_text_pollution",
    "other",
]
EXTRA_TEXT_MIN_CHARS = 200
BAR_WIDTH = 20

# --- fixed values: output scoring -----------------------------------------
# valid JSON 0.4, tool key present 0.2, tool correct 0.3, non-empty arguments 0.1
SCORE_WEIGHTS_TENTHS = (4, 2, 3, 1)
MEAN_SCORE_DIGITS = 3

# --- fixed values: ChatML-style chat template (default rendering) ---------
CHATML_PRE = "<|im_start|>"
CHATML_POST = "<|im_end|>\n"
CHATML_GENERATION_PROMPT = "<|im_start|>assistant\n"

IGNORE_INDEX = -100
