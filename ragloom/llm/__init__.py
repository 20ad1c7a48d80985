"""Training-data operators: archives, scoring, deduplication, decontamination,
tokenization, sharding and the rules around them. Nothing else in the library
imports this subpackage."""
