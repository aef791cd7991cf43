"""riskspark.streaming"""
