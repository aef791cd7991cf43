"""riskspark.sources"""
