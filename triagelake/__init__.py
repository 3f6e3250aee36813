"""Review triage analytics as Spark DataFrame operators.

Sub-packages
------------
functions   column expressions: text clean-up, lexicon scoring, small helpers
operators   DataFrame -> DataFrame operators: guardrail, routing, risk, metrics ...
sources     readers and writers
plans       end-to-end flows built from the operators
streaming   the row-local scoring flow on a streaming source
"""
