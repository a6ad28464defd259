"""Fixed values.

Everything in this module must equal the values the original tool uses, or
the datasets it produces differ: category directories, instruction templates,
system texts, log-file categories, the evaluation prompts, the default grid
and the training defaults a config override may touch.  They are plain literals in
their natural order.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the original tool's)
# --------------------------------------------------------------------------

# Content categories and the directories below the game root that hold them,
# in map order (first match wins).
CATEGORY_DIR_MAP = {
    "event": ["events"],
    "decision": ["common/decisions"],
    "interaction": ["common/character_interactions"],
    "on_action": ["common/on_action"],
    "scripted_trigger": ["common/scripted_triggers"],
    "scripted_effect": ["common/scripted_effects"],
    "scripted_modifier": ["common/scripted_modifiers"],
    "scripted_rule": ["common/scripted_rules"],
    "script_value": ["common/script_values"],
    "trait": ["common/traits"],
    "modifier": ["common/modifiers", "common/event_modifiers", "common/static_modifiers"],
    "opinion_modifier": ["common/opinion_modifiers"],
    "casus_belli": ["common/casus_belli_types"],
    "culture": ["common/culture/cultures"],
    "faith": ["common/religion/religions"],
    "scheme": ["common/schemes"],
    "activity": ["common/activities/activity_types"],
    "council_task": ["common/council_tasks"],
    "lifestyle": ["common/lifestyles"],
    "focus": ["common/focuses"],
    "law": ["common/laws"],
    "building": ["common/buildings"],
    "holding": ["common/holdings"],
    "men_at_arms": ["common/men_at_arms_types"],
    "court_position": ["common/court_positions"],
    "dynasty_legacy": ["common/dynasty_legacies"],
    "dynasty_perk": ["common/dynasty_perks"],
    "innovation": ["common/culture/innovations"],
    "perk": ["common/lifestyle_perks"],
    "faction": ["common/factions"],
    "government": ["common/governments"],
    "secret": ["common/secret_types"],
    "story_cycle": ["common/story_cycles"],
    "struggle": ["common/struggle"],
    "legend": ["common/legends"],
    "artifact": ["common/artifacts"],
    "inspiration": ["common/inspirations"],
    "travel": ["common/travel"],
    "accolade": ["common/accolade_types"],
    "succession_election": ["common/succession_election"],
    "flavorization": ["common/flavorization"],
    "nickname": ["common/nicknames"],
    "hook_type": ["common/hook_types"],
    "important_action": ["common/important_actions"],
    "game_rule": ["common/game_rules"],
    "bookmark": ["common/bookmarks"],
    "vassal_stance": ["common/vassal_stances"],
    "scripted_relation": ["common/scripted_relations"],
    "character_template": ["common/scripted_character_templates"],
    "customizable_loc": ["common/customizable_localization"],
    "landed_title": ["common/landed_titles"],
    "domicile": ["common/domiciles"],
    "dynasty": ["common/dynasties"],
    "dynasty_house": ["common/dynasty_houses"],
    "task_contract": ["common/task_contracts"],
    "great_project": ["common/great_projects"],
    "character_memory": ["common/character_memory_types"],
    "trigger_loc": ["common/trigger_localization"],
    "effect_loc": ["common/effect_localization"],
    "game_concept": ["common/game_concepts"],
    "subject_contract": ["common/subject_contracts"],
    "define": ["common/defines"],
    "situation": ["common/situation"],
    "house_aspiration": ["common/house_aspirations"],
    "event_background": ["common/event_backgrounds"],
    "event_theme": ["common/event_themes"],
    "council_position": ["common/council_positions"],
    "achievement": ["common/achievements"],
    "diarchy": ["common/diarchies"],
    "epidemic": ["common/epidemics"],
    "courtier_guest": ["common/courtier_guest_management"],
    "court_amenity": ["common/court_amenities"],
    "legitimacy": ["common/legitimacy"],
    "court_type": ["common/court_types"],
    "scripted_cost": ["common/scripted_costs"],
    "pool_selector": ["common/pool_character_selectors"],
    "scripted_gui": ["common/scripted_guis"],
    "raid": ["common/raids"],
    "event_transition": ["common/event_transitions"],
    "combat_effect": ["common/combat_effects"],
    "scripted_list": ["common/scripted_lists"],
    "succession_appointment": ["common/succession_appointment"],
    "confederation": ["common/confederation_types"],
    "combat_phase_event": ["common/combat_phase_events"],
    "lease_contract": ["common/lease_contracts"],
    "tax_slot": ["common/tax_slots"],
    "house_unity": ["common/house_unities"],
    "house_relation": ["common/house_relation_types"],
    "death_reason": ["common/deathreasons"],
    "guest_system": ["common/guest_system"],
    "ai_war_stance": ["common/ai_war_stances"],
    "message": ["common/messages"],
    "suggestion": ["common/suggestions"],
    "history": ["history"],
    "coat_of_arms": ["common/coat_of_arms"],
    "gene": ["common/genes"],
    "portrait_modifier": ["common/portrait_modifiers"],
    "portrait_type": ["common/portrait_types"],
    "dna_data": ["common/dna_data"],
    "ethnicity": ["common/ethnicities"],
    "bookmark_portrait": ["common/bookmark_portraits"],
    "graphical_unit": ["common/graphical_unit_types"],
    "scripted_animation": ["common/scripted_animations"],
    "modifier_icon": ["common/modifier_icons"],
    "accolade_icon": ["common/accolade_icons"],
    "accolade_name": ["common/accolade_names"],
    "named_color": ["common/named_colors"],
    "event_2d_effect": ["common/event_2d_effects"],
    "decision_group": ["common/decision_group_types"],
    "interaction_category": ["common/character_interaction_categories"],
    "character_background": ["common/character_backgrounds"],
    "casus_belli_group": ["common/casus_belli_groups"],
    "ai_goaltype": ["common/ai_goaltypes"],
    "dynasty_house_motto": ["common/dynasty_house_mottos", "common/dynasty_house_motto_inserts"],
    "tutorial": ["common/tutorial_lessons", "common/tutorial_lesson_chains"],
    "modifier_format": ["common/modifier_definition_formats"],
    "message_filter": ["common/message_filter_types", "common/message_group_types"],
    "province_terrain": ["common/province_terrain", "common/terrain_types"],
    "playable_difficulty": ["common/playable_difficulty_infos"],
    "ruler_objective": ["common/ruler_objective_advice_types"],
    "connection_arrow": ["common/connection_arrows"],
    "console_group": ["common/console_groups"],
    "gfx": ["gfx"],
    "gui": ["gui"],
    "sound_def": ["sound"],
    "music_def": ["music"],
    "font_def": ["fonts"],
}

# File extensions of script files.
SCRIPT_EXTENSIONS = [".txt", ".gui", ".asset", ".csv", ".shader", ".fxh",
                     ".skin", ".font", ".map", ".shortcuts"]

# Path parts that exclude a file from the raw corpus.
SKIP_DIRS = ["dlc", "tools", "content_source", "data_binding", "licenses",
             "dlc_metadata", "tweakergui_assets", "tests", "notifications",
             "reader_export"]

# Instruction templates per category, in list order; categories not listed
# use DEFAULT_TEMPLATES.  Placeholders: {name}, {category}, {loc_desc}.
INSTRUCTION_TEMPLATES = {
    "event": [
        "Write a CK3 event called '{name}'",
        "Create the CK3 event '{name}' that {loc_desc}",
        "Write CK3 script for event '{name}'",
    ],
    "decision": [
        "Write a CK3 decision called '{name}'",
        "Create a CK3 decision '{name}' that {loc_desc}",
    ],
    "interaction": [
        "Write a CK3 character interaction called '{name}'",
        "Create a CK3 interaction '{name}'",
    ],
    "scripted_trigger": [
        "Write a CK3 scripted trigger called '{name}'",
    ],
    "scripted_effect": [
        "Write a CK3 scripted effect called '{name}'",
    ],
    "scripted_modifier": [
        "Write a CK3 scripted modifier called '{name}'",
    ],
    "scripted_rule": [
        "Write a CK3 scripted rule called '{name}'",
    ],
    "script_value": [
        "Write a CK3 script value called '{name}'",
        "Define the CK3 script value '{name}'",
    ],
    "trait": [
        "Define a CK3 trait called '{name}'",
        "Write the CK3 trait definition for '{name}' that {loc_desc}",
    ],
    "on_action": [
        "Write a CK3 on_action hook called '{name}'",
    ],
    "faction": [
        "Write a CK3 faction type called '{name}'",
    ],
    "government": [
        "Write a CK3 government type called '{name}'",
    ],
    "holding": [
        "Write a CK3 holding type called '{name}'",
    ],
    "focus": [
        "Write a CK3 lifestyle focus called '{name}'",
    ],
    "story_cycle": [
        "Write a CK3 story cycle called '{name}'",
    ],
    "struggle": [
        "Write a CK3 struggle definition called '{name}'",
    ],
    "legend": [
        "Write a CK3 legend type called '{name}'",
    ],
    "artifact": [
        "Write a CK3 artifact definition called '{name}'",
    ],
    "secret": [
        "Write a CK3 secret type called '{name}'",
    ],
    "succession_election": [
        "Write a CK3 succession election type called '{name}'",
    ],
    "opinion_modifier": [
        "Write a CK3 opinion modifier called '{name}'",
    ],
    "character_template": [
        "Write a CK3 scripted character template called '{name}'",
    ],
    "scripted_relation": [
        "Write a CK3 scripted relation called '{name}'",
    ],
}

DEFAULT_TEMPLATES = [
    "Write the CK3 script block '{name}'",
    "Create a CK3 {category} called '{name}'",
]

# System texts of the three instruction sources and the chat default.
SYSTEM_SCRIPT = (
    "You are a CK3 modding expert. Write valid Crusader Kings III script code. "
    "Use correct scope chains, proper trigger/effect placement, and follow vanilla patterns. "
    "Only output the script code, no explanations."
)
SYSTEM_LOCALIZATION = "You are a CK3 modding expert. Write valid CK3 localization in YML format."
SYSTEM_ENGINE = (
    "You are a CK3 modding expert. You have deep knowledge of the CK3 script engine, "
    "including all effects, triggers, scopes, and their valid usage patterns."
)
SYSTEM_CHAT_DEFAULT = "You are a CK3 modding expert."

# Engine log files and their categories, in processing order.
LOG_FILE_CATEGORIES = [
    ("effects.log", "effect_reference"),
    ("triggers.log", "trigger_reference"),
    ("on_actions.log", "on_action_reference"),
    ("modifiers.log", "modifier_reference"),
    ("event_scopes.log", "scope_reference"),
    ("event_targets.log", "event_target_reference"),
    ("custom_localization.log", "custom_loc_reference"),
]

# Questions asked about a log entry; the first category substring that
# matches picks the question ("other" is the fallback).
LOG_QUESTIONS = [
    ("effect", "What does the CK3 effect '{name}' do? What scopes does it support?"),
    ("trigger", "What does the CK3 trigger '{name}' do? What scopes does it support?"),
    ("on_action", "Describe the CK3 on_action '{name}'. What scope does it expect?"),
    ("modifier", "What is the CK3 modifier '{name}'?"),
    ("scope", "Describe the CK3 scope type '{name}' and its capabilities."),
    ("event_target", "What is the CK3 event target '{name}'?"),
    ("custom_loc", "Describe the CK3 custom localization '{name}'."),
    ("other", "Describe the CK3 engine element '{name}'."),
]
DATA_TYPE_QUESTION = "What is the CK3 engine type or function '{name}'? What does it return?"

# Localization-pair text.
LOC_INSTRUCTION = "Write CK3 localization entries for '{prefix}'"
LOC_HEADER = "l_english:"

# Description lookup: suffixes tried in order, and the fallback text.
DESC_SUFFIXES = ["", "_desc", "_tooltip", "_title"]
DESC_FALLBACK = "is a {category} definition"

# Chat markup.
CHAT_FORMAT = ("<|im_start|>system\n{system}<|im_end|>\n"
               "<|im_start|>user\n{instruction}<|im_end|>\n"
               "<|im_start|>assistant\n{completion}<|im_end|>")

# Evaluation benchmark, in order: id, category, instruction, checks.
EVAL_PROMPTS = [
    {
        "id": "eval_event_basic",
        "category": "event",
        "instruction": "Write a CK3 event where the player character discovers a hidden treasure map in their court. Include a title, description, trigger block, and two options.",
        "checks": ["title", "desc", "trigger", "option", "=", "{", "}"],
    },
    {
        "id": "eval_decision",
        "category": "decision",
        "instruction": "Write a CK3 decision that lets a ruler host a grand tournament. Include is_shown, is_valid, and effect blocks.",
        "checks": ["is_shown", "is_valid", "effect", "=", "{", "}"],
    },
    {
        "id": "eval_scripted_trigger",
        "category": "scripted_trigger",
        "instruction": "Write a CK3 scripted trigger called 'is_valid_knight_candidate' that checks if a character is an adult, not imprisoned, has prowess >= 8, and is not incapable.",
        "checks": ["is_adult", "is_imprisoned", "prowess", "has_trait", "=", "{", "}"],
    },
    {
        "id": "eval_on_action",
        "category": "on_action",
        "instruction": "Write a CK3 on_action that fires when a character gains a new trait, checking if they are a ruler and triggering an event.",
        "checks": ["trigger", "events", "is_ruler", "=", "{", "}"],
    },
    {
        "id": "eval_interaction",
        "category": "interaction",
        "instruction": "Write a CK3 character interaction for challenging someone to a duel. Include is_shown, is_valid_showing_failures_only, on_accept, and on_decline blocks.",
        "checks": ["is_shown", "is_valid", "on_accept", "=", "{", "}"],
    },
    {
        "id": "eval_scope_chain",
        "category": "scripted_effect",
        "instruction": "Write a CK3 scripted effect that saves the root character's liege's primary title holder's faith as a scope, then checks if the root character's culture has the same heritage as the scope target's culture.",
        "checks": ["save_scope_as", "root", "liege", "primary_title", "culture", "=", "{", "}"],
    },
    {
        "id": "eval_create_character",
        "category": "scripted_effect",
        "instruction": "Write a CK3 scripted effect that creates a new female character aged 20-30 with the 'brilliant_strategist' education trait, assigns her to the root character's court, and makes her a knight.",
        "checks": ["create_character", "female", "age", "trait", "add_courtier", "=", "{", "}"],
    },
    {
        "id": "eval_loc",
        "category": "localization",
        "instruction": "Write CK3 localization entries for an event called 'tournament_champion' with a title, description, and two option labels. Use proper loc key format.",
        "checks": ["l_english:", ":0", "\""],
    },
]

# Scoring: scope words, contamination markers, weights, rating bands.
SCOPE_WORDS = ["root", "scope:", "this", "prev", "trigger", "effect", "limit"]
CODE_MARKERS = ["def ", "import ", "class "]
SCORE_WEIGHTS = {"syntax": 0.4, "keyword": 0.3, "structure": 0.3}
RATING_BANDS = [(0.7, "PASS"), (0.4, "WARN")]  # else FAIL

# Split and mix.
SEED = 42
VAL_FRACTION = 0.05
CLM_VAL_CAP = 100
TIME_BUDGET = 300

# Default sweep grid (keys are sorted before expansion).
DEFAULT_GRID = {
    "LEARNING_RATE": [1e-4, 2e-4, 5e-4],
    "CLM_MIX_RATIO": [0.0, 0.1, 0.2, 0.3],
    "GRADIENT_ACCUMULATION": [4, 8],
    "NUM_EPOCHS": [1, 3],
    "LORA_DROPOUT": [0.0, 0.05],
}

# Training settings an override may replace, with their defaults.
TRAIN_DEFAULTS = {
    "LORA_R": "128",
    "LORA_ALPHA": "256",
    "LORA_DROPOUT": "0.0",
    "LEARNING_RATE": "0.0002",
    "BATCH_SIZE": "1",
    "GRADIENT_ACCUMULATION": "4",
    "NUM_EPOCHS": "3",
    "WARMUP_RATIO": "0.05",
    "WEIGHT_DECAY": "0.01",
    "LR_SCHEDULER": "cosine",
    "TIME_BUDGET": "300",
    "CLM_MIX_RATIO": "0.2",
}
BASE_MODEL = "darkc0de/Qwen3.5-9B-heretic"

# Result-log columns as the sweep writes them.
RESULTS_COLUMNS = ["timestamp", "val_score", "syntax", "keyword", "structure",
                   "status", "elapsed_s", "config"]
RESULTS_NUMERIC = ["val_score", "syntax", "keyword", "structure", "elapsed_s"]
EXPERIMENT_LOG_COLUMNS = ["commit", "val_score", "memory_gb", "status", "description"]

# (map order, category, directory) of every content directory.
CATEGORY_DIRS = [(i, c, d) for i, (c, d) in enumerate((c, d) for c, dirs in CATEGORY_DIR_MAP.items() for d in dirs)]
