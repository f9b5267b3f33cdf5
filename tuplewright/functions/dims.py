"""Dimensions: label maps, rare labels, modes, defaults."""
from __future__ import annotations

# What a negative label looks like once trimmed, lower-cased and joined by underscores.
NEGATIVE = "NO_RELATION"
NEGATIVE_FORMS = ("no_relation", "no_relationship")

# Attribute labels, English to Korean.
ATTRIBUTE_LABELS = {
    "Loyalty": "충성도",
    "Effect": "효과",
    "Feel": "사용감",
    "Moisturizing Power": "보습력",
    "Convenience": "편리성",
    "Color": "색상",
    "Spreadability": "발림성",
    "Cleansing Power": "세정력",
    "Texture": "제형",
    "Longevity": "지속력",
    "Perceived Price": "인지가격",
    "Scent": "향",
    "Coverage": "커버력",
    "Capacity": "용량",
    "Package/Container Design": "패키지/용기_디자인",
    "Side Effects/Damage": "부작용/손상",
    "Ingredients": "성분",
    "Versatility": "활용성",
    "Single Item Design": "단품_디자인",
    "Pigmented/Color Payoff": "발색력",
    "Adhesion": "밀착력",
    "Absorption": "흡수력",
    "Quality": "품질",
    "Composition": "구성",
    "Delivery": "배송",
    "Expressiveness": "표현력",
    "Glossiness": "광감",
    "Portability": "휴대성",
    "Taste": "맛",
    "Promotion": "판촉",
    "Curling/Volume": "컬링/볼륨",
    "White Cast": "백탁현상",
    "Smudging": "번짐",
    "Clumping": "뭉침",
    "Shelf Life": "유통기한",
    "Powder Fallout": "가루날림",
    "Pearl Effect": "펄감",
    "Breakdown": "무너짐",
    "Service": "서비스",
}

# Attribute labels that become relations between entities.
ATTRIBUTE_TO_RELATION = {"Ingredients": "has_ingredient", "Effect": "affects", "Composition": "has_part", "Capacity": "has_attribute"}

# Relations that are rare by decree.
RARE = (
    "instance_of", "addresses", "applied_by", "purchases", "provided_to", "gifted_by", "frequency_of_use", "purchased_by",
    "benefits_user", "gifted_to", "sells", "uses", "has_part", "addressed_by_treatment", "addressed_to", "belongs_to",
    "described_by", "not_used_by", "requires", "perceives", "targeted_at", "available_to", "available_in", "causes",
    "experiences", "caused_by", "provided_by", "has_instance", "variant_of", "owns", "treats", "price_of", "information_to",
    "information_from", "sold_by", "required_by", "targeted_by", "child_of", "parent_of", "brand_of", "family_member_of",
)

# Share of chunks a dominant label should not exceed.
HEAD_CAPS = {"ner_ner": {"NO_RELATION": 0.35, "used_by": 0.14, "same_entity": 0.10}, "ner_bee": {"__bee_false__": 0.70}}

# Mode -> description, few-shot, summary, reasoning; and the share of rows of a mode.
MODES = {
    "system_only": (False, False, False, False),
    "full_detailed": (True, True, False, False),
    "full_summary": (True, True, True, False),
    "no_fewshot": (True, False, False, False),
    "reasoning": (False, False, False, True),
}
MODE_RATIOS = (("system_only", 0.2), ("full", 0.6), ("no_fewshot", 0.2), ("reasoning", 0.0))
FULL_DETAILED_RATIO = 0.7

# The order in which tasks are split; an origin of several is placed by the first.
TASKS = ("ner_ner", "ner_bee", "ner_bee_true_only")

# Model format -> tag that begins the model's turn, stop tokens.
FORMATS = {
    "gemma4": ("<|turn>model\n", ("<turn|>",)),
    "gemma3": ("<start_of_turn>model\n", ("<end_of_turn>",)),
    "qwen": ("<|im_start|>assistant\n", ("<|im_end|>",)),
}

# Keys of prompt settings -> the task whose prompt they hold.
PROMPT_KEYS = {
    "system_prompt_combine_all": "COMBINE_ALL",
    "system_prompt_ner_bee_true_only": "NER-BEE_TRUE_ONLY",
    "system_prompt_ner_bee": "NER-BEE",
    "system_prompt_ner_ner": "NER-NER",
    "system_prompt_bee_bee": "BEE-BEE",
}

# Relation assumed where an answer names none.
DEFAULT_RELATION = {"NER-BEE": "true", "NER-BEE_TRUE_ONLY": "true", "NER-NER": "no_relation", "BEE-BEE": "no_relation", "COMBINE_ALL": "true", "UNKNOWN": "true"}

# Task names of data sets -> task names of answers.
TASK_NAMES = {"ner_ner": "NER-NER", "ner_bee": "NER-BEE", "combine_all": "COMBINE_ALL"}
