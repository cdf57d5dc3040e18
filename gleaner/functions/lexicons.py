"""Word lists, thresholds and label tables: configuration of the rules, all injectable."""

from __future__ import annotations

# They must equal those of the system whose results are matched.
KEYWORD_STOPWORDS = ("the", "a", "an", "and", "or", "to", "of", "in", "for", "with", "on", "by", "is", "are", "的", "了", "和", "与", "或", "及", "在", "是", "对", "通过", "用于", "一个")
SECTION_STOPWORDS = ("the", "and", "for", "with", "that", "this", "from", "are", "was", "were", "has", "have", "their", "than", "then", "there", "which", "的", "了", "和", "与", "在", "是", "对", "为", "中")
GENERIC_TERMS = (
    "this", "that", "these", "those", "the", "and", "or", "its", "it", "reads", "maps", "extracts", "generates", "method", "model", "system", "result", "concept", "fact",
    "问题", "方法", "背景", "约束", "过程", "模型", "系统", "结果", "概念", "事实", "这里", "这些", "每个",
)
ANCHOR_STOPWORDS = ("the", "and", "with", "that", "this", "from", "into", "their", "there", "because", "文章", "什么", "如何", "为什么", "这个", "这些", "其中")

#: Card types in order of precedence: (type, terms in the raw sentence, terms in the lower-cased sentence).
CARD_TYPES = (
    ("cause_effect", ("因为", "因此", "导致", "使得", "原因"), ("because", "therefore", "leads to", "resulting")),
    ("mechanism", ("通过", "机制", "过程", "步骤"), ("mechanism", "process", "by using")),
    ("contrast_tradeoff", ("相比", "不同", "取舍", "然而", "但"), ("however", "whereas", "while", "tradeoff", "unlike")),
    ("condition_boundary", ("如果", "当", "只有", "限制", "条件", "必须", "不能"), ("if", "when", "only", "must", "cannot", "constraint", "limitation")),
    ("implication", ("意味着", "说明", "表明", "容易", "可以"), ("implies", "suggests", "shows", "can", "could")),
    ("evidence_result", ("结果", "实验", "性能"), ("result", "experiment", "performance")),
)
DEFAULT_CARD_TYPE = "core_claim"
ALL_CARD_TYPES = ("core_claim", "mechanism", "cause_effect", "condition_boundary", "contrast_tradeoff", "implication", "evidence_result", "procedure_logic")
REASONING_TYPES = ("mechanism", "cause_effect", "contrast_tradeoff", "condition_boundary")
QUALITY_EN = ("because", "therefore", "however", "while", "although", "so that")
QUALITY_ZH = ("因为", "因此", "然而", "虽然", "导致", "取决于", "限制", "相比")
REASONING_HOOKS = {
    "mechanism": "需要解释机制，而不是复述定义。",
    "cause_effect": "需要串联原因和结果。",
    "condition_boundary": "需要识别适用条件和限制。",
    "contrast_tradeoff": "需要比较取舍及其影响。",
    "implication": "需要解释结论意味着什么。",
    "evidence_result": "需要把结果和依据联系起来。",
    "procedure_logic": "需要解释步骤顺序和作用。",
}
DEFAULT_HOOK = "需要基于证据综合文章的核心论述。"

#: Fact types in order of precedence, on normalised text; numeric comes before all of them.
FACT_TYPES = (
    ("condition", ("if", "when", "under", "unless", "如果")),
    ("cause_effect", ("because", "therefore", "lead", "allows", "enable", "因此")),
    ("constraint", ("must", "should", "cannot", "require", "need", "不能", "必须")),
    ("procedure", ("first", "then", "finally", "step", "followed by")),
    ("comparison", ("compared", "whereas", "while", "unlike", "vs")),
    ("example", ("for example", "such as", "例如", "比如")),
    ("definition", ("is", "are", "refers to", "defined as")),
)
CONFIDENCE_CUES = (" is ", " are ", " because ", " allows ", " enables ", " must ")
#: The document-level variant, on raw text in lower case.
DOCUMENT_FACT_TYPES = (
    ("condition", ("如果", "when", "if")),
    ("cause_effect", ("因为", "导致", "therefore", "because", "so that")),
    ("constraint", ("必须", "不能", "should", "must", "require")),
    ("procedure", ("步骤", "首先", "然后", "最后", "step")),
    ("comparison", ("相比", "比", "different", "compared")),
    ("example", ("例如", "for example", "比如")),
)
DOCUMENT_CONFIDENCE_CUES = ("必须", "不能", "因为", "导致", "例如", "包括", "is", "are")

CONCEPT_TYPES = (
    ("method", ("attention", "transformer", "architecture", "network", "mechanism")),
    ("component", ("encoder", "decoder", "layer", "embedding", "head")),
    ("metric", ("bleu", "score", "metric")),
)
PRONOUNS = (
    "this", "that", "these", "those", "it", "its", "they", "them", "their", "theirs", "we", "our", "ours", "you", "your", "yours", "i", "me", "my", "mine",
    "each", "all", "both", "either", "neither", "another", "other", "others",
)
GENERIC_NAMES = ("paper", "work", "approach", "method", "model", "models", "system", "result", "results", "thing", "things", "part", "section", "example", "examples", "table", "figure")
AFFILIATIONS = ("google", "brain", "research", "university", "toronto", "provided", "permission", "journalistic", "scholarly", "works", "email", "gmail")
DOMAIN_KEYWORDS = (
    "attention", "transformer", "encoder", "decoder", "embedding", "head", "layer", "normalization", "bleu", "network", "architecture", "representation", "translation",
    "sequence", "recurrent", "convolutional", "softmax", "dropout", "training", "position", "positional", "feed-forward", "feed", "forward", "model",
)
CANONICAL_BLACKLIST = ("the", "a", "an", "this", "that", "these", "those", "provided", "listing", "equal", "experiments", "experiment", "english", "french", "englishto-german", "jakob")
DOMAIN_ALLOWLIST = (
    "transformer", "attention", "encoder", "decoder", "bleu", "embedding", "network", "normalization", "residual", "feed-forward", "gpu", "gpus", "wmt", "architecture",
    "position", "representation", "training", "sequence", "translation", "head", "layer",
)
NOISE_PHRASES = ("provided proper attribution", "permission to make digital or hard copies", "copyright", "journalistic or scholarly works", "google hereby grants permission")
UNIT_NOISE = ("copyright", "permission to", "references", "bibliography")

RELATIONS = {"definition": "defines", "constraint": "constrains", "cause_effect": "causes", "comparison": "compares", "procedure": "explains", "config": "configures", "example": "example_of"}
DEFAULT_RELATION = "mentioned_by"
PATTERNS = (("comparison", "concept_comparison"), ("cause_effect", "cause_effect_chain"), ("constraint", "constraint_reasoning"), ("condition", "condition_action"), ("procedure", "procedure_chain"))
DEFAULT_PATTERN = "multi_fact_synthesis"
QUESTION_TYPES = {"concept_comparison": "comparison", "cause_effect_chain": "cause_effect", "constraint_reasoning": "constraint", "condition_action": "scenario", "procedure_chain": "procedure"}
INTENDED_QUESTIONS = {
    "comparison": "比较相关概念或方法的异同与适用场景",
    "cause_effect": "说明原因、机制与影响",
    "constraint": "解释约束、原因和使用边界",
    "procedure": "梳理流程步骤与先后关系",
    "scenario": "结合条件判断该怎么做",
}
DEFAULT_INTENDED = "综合多个事实回答真实问题"
RENDERED_QUESTIONS = {
    "comparison": "这些概念或方法之间的主要差异和共同点是什么？",
    "cause_effect": "为什么会出现这种结果，它会带来什么影响？",
    "procedure": "这个流程应该按什么顺序执行，各步骤分别起什么作用？",
    "constraint": "这里有哪些关键约束，这些约束为什么重要？",
    "scenario": "在满足这些条件的情况下，应该如何处理？",
}
UNSUPPORTED_ANSWERS = ("引入文档未出现的外部知识", "忽略关键条件或限制")

VAGUE_QUESTIONS = ("综合多个事实", "回答真实问题", "这些概念", "这些事实", "这种结果", "这个流程", "这里有哪些", "上述", "前文", "该方法", "该系统", "该模型")
QUESTION_SHAPE_EN = ("why", "what", "how", "mechanism", "makes", "better", "compare")
QUESTION_SHAPE_ZH = ("为什么", "什么", "如何", "机制", "更好", "优势", "比较")
BROAD_ENTITIES = ("transformer", "architecture", "system", "model", "framework", "pipeline", "架构", "系统", "模型", "方法")
REASONING_QUESTION_TERMS = ("为什么", "如何解释", "取舍", "边界", "意味着", "因果", "依据", "机制", "影响")
VALUED_TYPES = ("mechanism", "cause_effect", "condition_boundary", "contrast_tradeoff", "implication")
COMPATIBLE_TYPES = (
    ("cause_effect", "implication"),
    ("implication", "mechanism"),
    ("condition_boundary", "mechanism"),
    ("cause_effect", "condition_boundary"),
    ("contrast_tradeoff", "implication"),
    ("evidence_result", "implication"),
)
AMBIGUOUS_TERMS = ("这个", "那个", "它们", "something", "things")
# End of the fixed values.

# Kinds of relations between facts that make one depend on the other, or set them against each other.
DEPENDS_RELATIONS = ("causes", "depends_on", "supports", "requires")
CONTRAST_RELATIONS = ("contrasts", "compares", "tradeoff")
# Lines that hold one of these are no knowledge of a section.
KNOWLEDGE_NOISE = ("provided proper attribution", "copyright", "permission to make", "journalistic or scholarly works", "google hereby grants permission")
# Compact labels of events.
EVENT_LABELS = ("chunk 级问题生成", "概念-事实图构建与事实组合", "fact 的 evidence 支持约束", "structure mapping, extraction, and QA generation", "文档外知识限制")
