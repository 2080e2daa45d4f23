"""Training-data operators: tokens, extraction, sharding, scoring, mixing, archives, chat, decontamination, joins, rules."""
