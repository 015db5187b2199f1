"""Composed feature models: functions from tables to tables, one for each node of the dataflow.

Every model is a full computation; ``gritstone.streaming.incremental`` adds the incremental modes around it.
"""
