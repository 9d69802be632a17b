"""quire: a PySpark-native engine for collections of digitised documents and the records of how they were made."""
