"""quire.functions"""
