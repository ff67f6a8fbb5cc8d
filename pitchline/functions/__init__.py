"""pitchline.functions"""
